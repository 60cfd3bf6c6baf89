"""Column expressions for names made from urls, titles and paths (keys of the listing jobs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from recordweave.functions.numbers import month_number
from recordweave.functions.text import first_group, none_if_empty, squeeze

#: Source region words and their codes.
REGIONS = {"northern": "NR", "southern": "SR", "western": "WR", "eastern": "ER", "north eastern": "NER", "nr": "NR", "sr": "SR", "wr": "WR", "er": "ER", "ner": "NER"}
#: Words that make a tender's link worth keeping.
KEYWORDS = ("Corrigendum", "Extension", "Successful", "RFP", "Postponement", "Qualified", "Amendment")
#: Marks of a report's class.
TBCB = r"(?i)tbcb|tariff\s+based\s+competitive\s+bidding|competitive\s+bidding\s+route|प्रतिस्पर्धी\s+बोली"
RTM = r"(?i)rtm|regulated\s+tariff\s+mechanism"
UNDER_CONSTRUCTION = r"(?i)\buc\b|under\s+construction|निर्माणाधीन"
COMPLETED = r"(?i)completed|commissioned|\bcomm\b|पूर्ण"


def strip_tags(c: Column) -> Column:
    return squeeze(F.regexp_replace(c, r"<[^>]+>", " "))


def url_file_name(url: Column) -> Column:
    """Last part of the path, decoded, with characters that file systems forbid replaced."""
    bare = F.regexp_replace(url, r"[?#].*$", "")
    last = F.element_at(F.split(bare, "/"), -1)
    decoded = F.coalesce(F.try_url_decode(F.replace(last, F.lit("+"), F.lit("%2B"))), last)
    return F.trim(F.regexp_replace(decoded, r'[\\/:*?"<>|]', "_"), F.lit("._"))


def strip_timestamp(name: Column) -> Column:
    return F.regexp_replace(name, r"(?i)^\d{9,}(?:pdf)?[_\-\s]*", "")


def strip_number(name: Column) -> Column:
    return F.regexp_replace(name, r"^\d{6,}[_\-\s]*", "")


def ordinal_word(n: Column) -> Column:
    tail = F.when((n % 100).between(10, 20), "th").when(n % 10 == 1, "st").when(n % 10 == 2, "nd").when(n % 10 == 3, "rd").otherwise("th")
    return F.concat(n.cast("string"), tail)


def nct_name(name: Column) -> Column:
    """`Nth_NCT_MoM.pdf` of a file name: its ordinal, else its first number of at most three digits; else the name."""
    stem, ext = stem_of(name), extension_of(name)
    stem = spaced(stem)
    shown = first_group(stem, r"(?i)\b(\d{1,3})(?:st|nd|rd|th)\b")
    suffix = F.lower(F.regexp_extract(stem, r"(?i)\b\d{1,3}(st|nd|rd|th)\b", 1))
    number = first_group(stem, r"\b(\d{1,3})\b").cast("int")
    label = F.coalesce(F.concat(shown, suffix), ordinal_word(number))
    return F.coalesce(F.concat(label, F.lit("_NCT_MoM"), ext), F.concat(F.coalesce(none_if_empty(stem), F.lit("file")), ext))


def stem_of(name: Column) -> Column:
    return F.regexp_replace(name, r"\.[^.]*$", "")


def extension_of(name: Column) -> Column:
    """The extension in lower case; .pdf where there is none."""
    return F.lower(F.coalesce(none_if_empty(F.regexp_extract(name, r"(\.[^.]*)$", 1)), F.lit(".pdf")))


def spaced(stem: Column) -> Column:
    return squeeze(F.replace(stem, F.lit("_"), F.lit(" ")))


def unnumbered(stem: Column) -> Column:
    """The stem without a leading number of six digits or more, with blanks for underscores."""
    return spaced(F.trim(F.regexp_replace(F.regexp_replace(stem, r"^\d{6,}", ""), r"^[_\- ]+", "")))


def meeting_label(stem: Column) -> Column:
    """`Nth CMETS-REG` of a file's stem, after its special class if it has one; a stem without a meeting stays as it is."""
    s = spaced(F.regexp_replace(F.regexp_replace(stem, r"\d{10,}", ""), r"^\d+[_\-\s]*", ""))
    low = F.lower(s)
    special = (
        F.when(low.rlike(r"additional\s*agenda[-\s]*\d*"), "Additional Agenda")
        .when(low.contains("revised agenda"), "Revised Agenda")
        .when(low.contains("corrigendum"), "Minutes Corrigendum")
        .when(low.contains("addendum"), "Addendum of Minutes")
        .when(low.contains("annex") | low.contains("exhibit"), "Annex")
    )
    full = r"(?i)(\d{1,3})(st|nd|rd|th)?\s*CMETS[-\s]*([A-Z]{2,3})"
    part = lambda k: first_group(s, full, k)
    named = F.concat(part(1), F.coalesce(part(2), F.lit("th")), F.lit(" CMETS-"), F.upper(part(3)))
    short = F.concat(first_group(s, r"(?i)(\d{1,3})\s*CMETS"), F.lit("th CMETS"))
    return F.concat(F.coalesce(F.concat(special, F.lit("_")), F.lit("")), F.coalesce(named, short, s))


def region_in(text: Column) -> Column:
    """The first region that a text names, by code, then by word."""
    low = F.lower(text)
    found = F.lit(None).cast("string")
    for code in ("NER", "NR", "ER", "WR", "SR"):
        found = F.coalesce(found, F.when(low.rlike(rf"\b{code.lower()}\b"), F.lit(code)))
    for word, code in (("north[ -]eastern", "NER"), ("northern", "NR"), ("western", "WR"), ("southern", "SR"), ("eastern", "ER")):
        found = F.coalesce(found, F.when(low.rlike(word), F.lit(code)))
    return found


def coordination_label(stem: Column, notice: Column) -> Column:
    """`Nth JCC-REG` of a file's stem, `Special JCC ..` of special ones, else the stem without its opening words.

    Of a special meeting of several regions the first and the last are named.
    """
    s = F.regexp_replace(spaced(F.trim(F.regexp_replace(stem, r"^\d+[_\-\s]*", ""))), r"\s*\(\d+\)\s*$", "")

    def without(x: Column, *openings: str) -> Column:
        for o in openings:
            x = F.trim(F.regexp_replace(x, rf"(?i)^{o}\s*", ""))
        return x

    told = without(s, r"meeting\s+notice\s*&\s*agenda\s*(for)?", r"meeting\s+notice\s*(for)?", r"notice\s*(for)?", r"agenda\s*(for)?")
    s = F.when(notice, told).otherwise(without(s, r"minutes\s*(of)?", r"mom\s*(of)?"))
    ordinal = F.concat(first_group(s, r"(?i)\b(\d{1,3})(?:st|nd|rd|th)\b"), F.lower(F.regexp_extract(s, r"(?i)\b\d{1,3}(st|nd|rd|th)\b", 1)))
    kind = F.lit(None).cast("string")
    for k in ("JCC", "JCCM", "JCM"):
        kind = F.coalesce(kind, F.when(s.rlike(rf"(?i)\b{k}\b"), F.lit(k)))
    region, special = region_in(s), s.rlike(r"(?i)\bspecial\b")
    codes = r"(?i)\b(NER|NR|ER|WR|SR)(?:\s*[-/]\s*(NER|NR|ER|WR|SR))+\b"
    several = F.concat(F.lit("Special "), F.coalesce(kind, F.lit("JCC")), F.lit(" "), F.upper(first_group(s, codes, 1)), F.lit("-"), F.upper(first_group(s, codes, 2)))
    return F.coalesce(F.concat(ordinal, F.lit(" "), kind, F.lit("-"), region), F.when(special, several), F.when(special, F.concat(F.lit("Special "), kind, F.lit("-"), region)), s)


def calendar_name(name: Column) -> Column:
    """`Bidding Calendar dd-mm-yyyy.pdf` of a file name; years of two digits are of this century."""
    junk = r"(?i)\b(annexure[-\s]*a|draft|approved|final|dated|as on dated|as on)\b"
    s = squeeze(F.regexp_replace(F.regexp_replace(F.replace(stem_of(name), F.lit("_"), F.lit(" ")), r"^\d+\s*", ""), junk, ""))
    date = F.replace(first_group(s, r"(\d{2}[-.]\d{2}[-.]\d{2,4})"), F.lit("."), F.lit("-"))
    date = F.when(F.length(date) == 8, F.concat(F.substring(date, 1, 6), F.lit("20"), F.substring(date, 7, 2))).otherwise(date)
    return F.concat(F.lit("Bidding Calendar"), F.coalesce(F.concat(F.lit(" "), date), F.lit("")), extension_of(name))


def revocation_name(name: Column) -> Column:
    """`Revocation upto may26.pdf` or `Excluded from upto ..` of a file name, without a date if it has none; others stay."""
    s = unnumbered(stem_of(name))
    low, ext = F.lower(s), extension_of(name)
    date = F.coalesce(first_group(low, r"upto\s+([a-z]+['\-\d]*)"), first_group(low, r"published\s+in\s+([a-z]+\d{2,4})"))
    upto = F.coalesce(F.concat(F.lit(" upto "), F.translate(date, "'-", "")), F.lit(""))
    return (
        F.when(low.contains("excluded"), F.concat(F.lit("Excluded from"), upto, ext))
        .when(low.contains("revocation") | low.contains("upto"), F.concat(F.lit("Revocation"), upto, ext))
        .otherwise(F.concat(F.coalesce(none_if_empty(s), F.lit("file")), ext))
    )


def margin_name(name: Column) -> Column:
    """The cleaned title of a margin or bay list: its words without those of its state of approval."""
    s = unnumbered(stem_of(name))
    low = F.lower(s)
    bays = squeeze(F.regexp_replace(s, r"(?i)\b(approved|final|r\d+)\b", ""))
    plain = lambda x: squeeze(F.translate(F.regexp_replace(x, r"(?i)\b(approved|final|rev[-\d]*)\b", ""), "-_", "  "))
    kept = (
        F.when(low.contains("allocation of bays"), bays)
        .when(low.contains("non re ss margin"), plain(s))
        .when(low.contains("re ss margin"), plain(F.regexp_replace(s, r"(?i)^re\s+", "")))
        .when(low.contains("status of margins"), s)
        .otherwise(F.coalesce(none_if_empty(s), F.lit("file")))
    )
    return F.concat(kept, extension_of(name))


def bulk_name(name: Column) -> Column:
    """`Bulk Consumer dd-mm-yyyy.pdf` of a file name: its date, or the end of its month (February always ends on 28)."""
    s = unnumbered(stem_of(name))
    month = first_group(s, r"20\d{2}[\s_]?(\d{2})").cast("int")
    last = F.when(month.isin(1, 3, 5, 7, 8, 10, 12), "31").when(month.isin(4, 6, 9, 11), "30").otherwise("28")
    by_month = F.concat_ws("-", last, F.lpad(month.cast("string"), 2, "0"), first_group(s, r"(20\d{2})[\s_]?\d{2}"))
    run = r"(\d{2})(\d{2})(20\d{2})"
    date = F.coalesce(first_group(s, r"(\d{2}-\d{2}-\d{4})"), F.when(month.isNotNull(), by_month), F.concat(first_group(s, run, 1), F.lit("-"), first_group(s, run, 2), F.lit("-"), first_group(s, run, 3)))
    return F.concat(F.lit("Bulk Consumer"), F.coalesce(F.concat(F.lit(" "), date), F.lit("")), extension_of(name))


def month_display(ym: Column) -> Column:
    return F.concat(F.date_format(F.to_date(ym, "yyyy-MM"), "MMM-yy"), F.lit("_RE effectiveness.pdf"))


def report_category(title: Column, file: Column) -> Column:
    """rtm_uc, tbcb_completed or tbcb_uc by the marks in title and file name; null where none fits."""
    text = F.concat_ws(" ", title, file)
    done, open_ = text.rlike(COMPLETED), text.rlike(UNDER_CONSTRUCTION)
    dated = F.lower(text).contains("commissioned_during") | F.lower(text).contains("commissioned_in")
    return (
        F.when(text.rlike(RTM), "rtm_uc")
        .when(text.rlike(TBCB) & done, "tbcb_completed")
        .when(text.rlike(TBCB) & open_, "tbcb_uc")
        .when(open_ & ~dated, "tbcb_uc")
        .when(done & ~dated, "tbcb_completed")
    )


def type_from_path(path: Column, source: str) -> Column:
    """The folder after the source's; a region folder is skipped."""
    parts = F.split(path, "/")
    at = F.array_position(parts, source).cast("int")
    first, second = F.get(parts, at), F.get(parts, at + 1)
    return F.when(at > 0, F.when(F.lower(first).isin(*REGIONS), second).otherwise(first))


def keyword_in(text: Column, words: tuple[str, ...] = KEYWORDS) -> Column:
    """The first keyword that stands alone in a text."""
    return F.coalesce(*[F.when(text.rlike(f"(?i)(?<![A-Za-z]){w}(?![A-Za-z])"), F.lit(w)) for w in words])


def title_matches(title: Column, wanted: str) -> Column:
    """Whether a title contains what is looked for and is no consultant's tender."""
    low = F.lower(title)
    return low.contains(wanted.lower()) & ~low.contains("consultant")


def region_code(name: Column) -> Column:
    mapped = F.create_map(*[F.lit(x) for kv in REGIONS.items() for x in kv])
    return mapped[F.lower(F.trim(name))]
