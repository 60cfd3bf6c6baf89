"""Column expressions for numbers and dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from recordweave.functions.text import all_groups, clean, first_group, is_valid, once

#: Patterns of capacities.
MW = r"(?i)([\d,]+\.?\d*)\s*MW"
COMMISSIONED = r"(?i)([\d,]+\.?\d*)\s*MW[^()]{0,80}?\(?\s*Commissioned\s*\)?"
COMMISSIONED_STRICT = r"(?i)([\d,]+\.?\d*)\s*MW(?:(?!MW)[^()]){0,80}?\(?\s*Commissioned\s*\)?"
TECHNOLOGY = r"(?i)(solar\+wind|solar|wind|bess|ess|hydro|hybrid|thermal|psp|pump\s*storage)\s*\(\s*([\d,.]+)\s*\)"
#: Technology words and the category each counts for.
CATEGORY = {"solar": "solar", "wind": "wind", "bess": "ess", "ess": "ess", "hydro": "hydro", "psp": "hydro", "pump storage": "hydro", "hybrid": "hybrid", "solar+wind": "hybrid", "thermal": "thermal"}
CATEGORIES = ("solar", "wind", "ess", "hydro", "hybrid", "thermal")
#: Forms of dates.
DATE_FORMS = (r"\b\d{2}[./-]\d{2}[./-]\d{4}\b", r"\b\d{4}[./-]\d{2}[./-]\d{2}\b", r"\b\d{1,2}\s+[A-Za-z]{3,9}\s+\d{4}\b")
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")


def month_number(c: Column) -> Column:
    """1 to 12 for a month's name or its first three letters."""
    known = {k: i for i, m in enumerate(MONTHS, 1) for k in (m, m[:3])}
    return F.create_map(*[F.lit(x) for kv in known.items() for x in kv])[F.lower(c)]


def number_or_null(c: Column) -> Column:
    v = F.trim(c)
    return F.when(~v.isin("", "N/A", "-", "null", "—"), F.regexp_replace(v, ",", "")).try_cast("double")


def number_or_zero(c: Column) -> Column:
    return F.coalesce(F.regexp_replace(F.trim(c), ",", "").try_cast("double"), F.lit(0.0))


def is_number_like(c: Column) -> Column:
    return F.coalesce(F.trim(c).rlike(r"^\d+(?:\.\d+)?$"), F.lit(False))


def numbers(c: Column, pattern: str) -> Column:
    found = F.transform(all_groups(F.coalesce(c, F.lit("")), pattern, 1), lambda x: F.regexp_replace(x, ",", "").try_cast("double"))
    return F.filter(found, lambda x: x.isNotNull())


def total(values: Column) -> Column:
    """Sum rounded to two places; null when there is none."""
    return F.when(F.size(values) > 0, F.round(F.aggregate(values, F.lit(0.0), lambda a, x: a + x), 2))


def all_mw(c: Column) -> Column:
    return numbers(c, MW)


def commissioned_mw(c: Column, strict: bool = False) -> Column:
    return numbers(c, COMMISSIONED_STRICT if strict else COMMISSIONED)


def technology_struct(c: Column) -> Column:
    """technology_mw as one struct; the text is searched once."""

    def of(x: Column) -> Column:
        out = []
        for cat in CATEGORIES:
            words = [w for w, k in CATEGORY.items() if k == cat]
            named = x["low"].contains(words[0])
            for w in words[1:]:
                named = named | x["low"].contains(w)
            out.append(once(F.filter(x["found"], _of_words(words)), _sum_or(F.when((F.size(x["found"]) == 0) & named, F.lit(0.0)))).alias(cat))
        return F.struct(*out)

    text = F.coalesce(F.trim(c), F.lit(""))
    found = lambda t: F.zip_with(all_groups(t, TECHNOLOGY, 1), all_groups(t, TECHNOLOGY, 2), lambda n, v: F.struct(F.regexp_replace(F.lower(n), r"\s+", " ").alias("n"), number_or_zero(v).alias("v")))
    return once(text, lambda t: once(F.struct(F.lower(t).alias("low"), found(t).alias("found")), of))


def _of_words(words: list[str]):
    return lambda y: y["n"].isin(*words)


def _sum_or(otherwise: Column):
    """What adds up the values of found technologies, or gives this where there are none."""
    return lambda mine: F.when(F.size(mine) > 0, F.aggregate(mine, F.lit(0.0), lambda a, y: a + y["v"])).otherwise(otherwise)


def technology_mw(c: Column) -> dict[str, Column]:
    """Per category the sum of the MW in parentheses; 0 where it is only named; null where it is not."""
    made = technology_struct(c)
    return {cat: made[cat] for cat in CATEGORIES}


def date_text(c: Column) -> Column:
    """The first date in a text, as written."""
    return F.coalesce(*[first_group(clean(c), p, 0) for p in DATE_FORMS])


def parse_date(c: Column) -> Column:
    def of(v: Column) -> Column:
        dots = F.regexp_replace(v, "[/-]", ".")
        day = lambda p, f: F.try_to_date(first_group(dots, p, 0), f)
        named = r"\b(\d{1,2})\s+([A-Za-z]{3,9})\s+(\d{4})\b"
        spelled = F.concat_ws(".", F.lpad(first_group(v, named, 1), 2, "0"), F.lpad(month_number(first_group(v, named, 2)).cast("string"), 2, "0"), first_group(v, named, 3))
        return F.coalesce(day(r"\b\d{2}\.\d{2}\.\d{4}\b", "dd.MM.yyyy"), day(r"\b\d{4}\.\d{2}\.\d{2}\b", "yyyy.MM.dd"), F.when(F.length(spelled) == 10, F.try_to_date(spelled, "dd.MM.yyyy")))

    return once(F.when(is_valid(c), F.trim(c)), of)


def format_date(d: Column) -> Column:
    return F.date_format(d, "dd.MM.yyyy")


def later(a: Column, b: Column) -> Column:
    return F.greatest(a, b)


def in_future(d: Column, as_of: Column) -> Column:
    return F.when(d > as_of, "Yes").when(d.isNotNull(), "No")


def meeting_number(c: Column) -> Column:
    return F.coalesce(
        first_group(c, r"(?i)(\d{1,3})\s*(?:st|nd|rd|th)\s+(?:consulting\s+meeting|cmets)"),
        first_group(c, r"(?i)CMETS(?:_[A-Z]{1,3})?[/\\](\d{1,3})"),
        first_group(c, r"(?i)meeting\s+(?:no\.?\s*|number\s*)(\d{1,3})"),
    )


_NAMES = "|".join([*MONTHS, *[m[:3] for m in MONTHS if m != "may"]])


def meeting_date(c: Column) -> Column:
    """A date with a spelled month, as dd.mm.yyyy."""

    def shown(text: Column, pattern: str, d: int, m: int, y: int) -> Column:
        # the text is searched once for each form; the parts are taken from the match alone
        def parts(match: Column) -> Column:
            day, month, year = first_group(match, pattern, d).cast("int"), month_number(first_group(match, pattern, m)), first_group(match, pattern, y).cast("int")
            return once(F.struct(day.alias("d"), month.alias("m"), year.alias("y")), lambda p: F.when(p["d"].between(1, 31) & p["y"].between(2000, 2099), F.concat_ws(".", F.lpad(p["d"].cast("string"), 2, "0"), F.lpad(p["m"].cast("string"), 2, "0"), p["y"].cast("string"))))

        return once(first_group(text, pattern, 0), lambda match: F.when(match.isNotNull(), parts(match)))

    forms = ((rf"(?i)(\d{{1,2}})\s*(?:st|nd|rd|th)?\s+({_NAMES})\s+(\d{{4}})", 1, 2, 3), (rf"(?i)({_NAMES})\s+(\d{{1,2}})\s*(?:st|nd|rd|th)?,?\s+(\d{{4}})", 2, 1, 3))
    return once(c, lambda text: F.coalesce(*[shown(text, *f) for f in forms]))


def month_folder(ym: Column) -> Column:
    return F.date_format(F.to_date(ym, "yyyy-MM"), "MM_MMMM")
