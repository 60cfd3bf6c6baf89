"""Column expressions for identifiers, names and labels (no Python runs on rows)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: States and union territories.
STATES = (
    "andhra pradesh", "arunachal pradesh", "assam", "bihar", "chhattisgarh", "goa", "gujarat", "haryana", "himachal pradesh", "jharkhand",
    "karnataka", "kerala", "madhya pradesh", "maharashtra", "manipur", "meghalaya", "mizoram", "nagaland", "odisha", "punjab", "rajasthan",
    "sikkim", "tamil nadu", "telangana", "tripura", "uttar pradesh", "uttarakhand", "west bengal", "andaman and nicobar islands", "chandigarh",
    "dadra and nagar haveli and daman and diu", "delhi", "jammu and kashmir", "ladakh", "lakshadweep", "puducherry",
)
#: Texts that stand for nothing, by rule.
NULL_WORDS = ("null", "none", "na", "n/a", "-", "--")
INVALID_WORDS = ("", "none", "null", "na", "n/a", "-", "--", "nan")
BLANK_WORDS = ("", "nan", "none", "null")
#: Patterns of identifiers, company endings and bay lists.
ENHANCEMENT = r"(?i)\b(5\.?2|regulation\s*5\.?2|enhancement|revision)\b"
STAGE_TWO = r"(?i)\b(stage\s*ii|st\s*ii|gna/st\s*ii)\b"
COMPANY_SUFFIX = r"\s*(pvt\.?\s*ltd\.?|ltd\.?|llp|private\s+limited|limited)\s*$"
BAY_PATTERNS = (
    r"(?i)\bbay(?:s)?\s*(?:no\.?|nos\.?|number)?\s*[:\-]?\s*([A-Z]?\d+[A-Z]?(?:\s*(?:,|/|&|and)\s*[A-Z]?\d+[A-Z]?)*)(?:\b|[^A-Za-z0-9])",
    r"(?i)\bbay(?:s)?\s*(?:allocated|provided|identified|proposed)\s*[:\-]?\s*([A-Z]?\d+[A-Z]?(?:\s*(?:,|/|&|and)\s*[A-Z]?\d+[A-Z]?)*)(?:\b|[^A-Za-z0-9])",
)
STANDARD_VOLTAGES = ("765", "400", "220", "132", "110", "66", "33")


def none_if_empty(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def once(value: Column, use) -> Column:
    """use(value), with the value worked out once for a row however often it is used."""
    return F.get(F.transform(F.array(value), lambda once_: use(once_)), 0)


def all_groups(c: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(c, F.lit(pattern), F.lit(group))


def first_group(c: Column, pattern: str, group: int = 1) -> Column:
    return none_if_empty(F.regexp_extract(c, pattern, group))


def clean(c: Column) -> Column:
    t = F.trim(c)
    return F.when(F.lower(t).isin(*NULL_WORDS), F.lit(None)).otherwise(none_if_empty(t))


def is_valid(c: Column) -> Column:
    return F.coalesce(~F.lower(F.trim(c.cast("string"))).isin(*INVALID_WORDS), F.lit(False))


def is_blank(c: Column) -> Column:
    return F.coalesce(F.lower(F.trim(c.cast("string"))).isin(*BLANK_WORDS), F.lit(True))


def is_single_digit(c: Column) -> Column:
    return ~is_blank(c) & F.trim(c).rlike(r"^\d$")


def squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"\s+", " "))


def compact(c: Column) -> Column:
    return F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]+", "")


def normalize(c: Column) -> Column:
    return F.lower(squeeze(c))


def normalize_id(c: Column) -> Column:
    # runs that stay are put together: taking out the others took ten times as long
    return F.array_join(all_groups(F.lower(F.coalesce(c, F.lit(""))), r"[a-z0-9/\-]+"), "")


def ids_by_space(c: Column) -> Column:
    return F.filter(F.split(F.coalesce(c, F.lit("")), r"[,;\s]+"), lambda x: x != "")


def ids_by_mark(c: Column) -> Column:
    """Null gives no identifier."""
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), r"[;,|\n]+"), lambda x: F.trim(x)), lambda x: x != "")


def long_numbers(c: Column) -> Column:
    return F.coalesce(all_groups(clean(c), r"\b\d{6,}\b"), F.array().cast("array<string>"))


def numeric_ids(c: Column, strip_zeros: bool = False) -> Column:
    found = long_numbers(c)
    shown = F.transform(found, lambda x: F.coalesce(none_if_empty(F.ltrim(x, F.lit("0"))), F.lit("0"))) if strip_zeros else found
    return F.when(F.size(found) > 0, F.array_join(shown, ", ")).otherwise(clean(c))


def enhancement_id(enh: Column, gna: Column, lta: Column, mode: Column) -> Column:
    """The identifier under the enhancement rule: from the enhancement, then the first, then the second ID column."""
    other = lambda ids: F.get(F.filter(ids, lambda x: ~x.startswith("04")), 0)

    def of(x: Column) -> Column:
        pick = lambda ids: F.when(x["second"], other(ids)).otherwise(F.coalesce(other(ids), F.get(ids, 0)))
        last = F.when(F.size(x["t"]) == 1, other(x["t"])).otherwise(pick(x["t"]))
        return F.coalesce(pick(x["e"]), pick(x["g"]), last)

    found = lambda every: once(F.struct(every.rlike(STAGE_TWO).alias("second"), long_numbers(enh).alias("e"), long_numbers(gna).alias("g"), long_numbers(lta).alias("t")), of)
    return once(F.concat_ws(" ", *[F.coalesce(x, F.lit("")) for x in (enh, gna, lta, mode)]), lambda every: F.when(every.rlike(ENHANCEMENT), found(every)))


def state(location: Column) -> Column:
    """The longest state name contained, else the last part after a comma."""

    def of(x: Column) -> Column:
        named = [F.when(x["low"].contains(s), s) for s in sorted(STATES, key=len, reverse=True)]
        tail = none_if_empty(F.lower(F.trim(F.element_at(F.split(x["loc"], ","), -1), F.lit(" ."))))
        return F.coalesce(*named, F.when(x["loc"].contains(","), tail))

    return once(clean(location), lambda loc: once(F.struct(loc.alias("loc"), F.lower(loc).alias("low")), of))


def status(c: Column) -> Column:
    v, low = clean(c), F.lower(clean(c))
    return F.when(low.contains("withdraw"), "Withdrawn").when(low.contains("revoke"), "Revoked").when(low.contains("grant"), "granted").otherwise(v)


def developer(c: Column) -> Column:
    v = clean(c)
    return F.when(~F.upper(v).rlike(" LOA|CRITERION|APPLYING"), v)


def mode_bucket(c: Column) -> Column:
    v = clean(c)
    return F.when(v.rlike("(?i)LOA|PPA"), "LOA or PPA").when(v.isNotNull(), "Land BG")


def project_type(c: Column) -> Column:
    pattern = r"(?i)(solar|wind|bess|hybrid)(?:\s*\(([^)]*)\))?"
    names = F.create_map(*[F.lit(x) for kv in (("solar", "Solar"), ("wind", "Wind"), ("bess", "BESS"), ("hybrid", "Solar+Wind")) for x in kv])
    parts = F.zip_with(all_groups(clean(c), pattern, 1), all_groups(clean(c), pattern, 2), lambda k, v: F.concat(names[F.lower(k)], F.when(F.trim(v) != "", F.concat(F.lit(" ("), F.trim(v), F.lit(")"))).otherwise("")))
    return none_if_empty(F.array_join(parts, " + "))


def voltage_text(c: Column) -> Column:
    v = clean(c)
    return F.coalesce(F.concat(first_group(v, r"(?i)(\d{2,3})\s*kV"), F.lit(" kV")), v)


def voltage_key(c: Column) -> Column:
    v = F.regexp_replace(F.lower(c), r"[\s\-_]+", "")
    return F.when(v.contains("220"), "220kv").when(v.contains("400"), "400kv")


def name_key(c: Column) -> Column:
    s = F.regexp_replace(F.lower(F.trim(F.coalesce(c, F.lit("")))), COMPANY_SUFFIX, "")
    return F.trim(F.regexp_replace(F.regexp_replace(s, r"[.\-,;:()]+", " "), r"\s+", " "))


def without_parentheses(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\(.*?\)", ""))


#: Marks of pump storage.
PUMP = r"(?i)\b(pump\s*storage|psp)\b"


def pump_storage(*values: Column) -> tuple[Column, Column, Column]:
    """MWh, injection and drawl, only where the texts speak of pump storage."""
    text = F.concat_ws(" ", *[F.coalesce(v, F.lit("")) for v in values])
    on = text.rlike(PUMP)
    energy = F.coalesce(first_group(text, r"(?i)for\s+(\d+(?:\.\d+)?)\s*(?:MWh|MW)"), first_group(text, r"(?i)(\d+(?:\.\d+)?)\s*MWh"))
    return (
        F.when(on, energy),
        F.when(on, first_group(text, r"(?i)(?:max\s*)?injection\s*[:\-]?\s*(\d+(?:\.\d+)?)")),
        F.when(on, first_group(text, r"(?i)(?:max\s*)?(?:drawl|drawal)\s*[:\-]?\s*(\d+(?:\.\d+)?)")),
    )


def battery(mwh: Column, injection: Column, drawl: Column, *context: Column) -> tuple[Column, Column, Column]:
    """Battery values pass where the texts speak of a battery; numbers are taken by pattern, no model is asked."""
    text = F.concat_ws(" ", *[F.coalesce(v, F.lit("")) for v in (mwh, injection, drawl, *context)])
    on = text.rlike(r"(?i)\b(bess|battery|ess)\b")
    number = lambda c, p: F.when(on, F.coalesce(clean(c), first_group(text, p)))
    return number(mwh, r"(?i)(\d+(?:\.\d+)?)\s*MWh"), number(injection, r"(?i)injection\s*[:\-]?\s*(\d+(?:\.\d+)?)"), number(drawl, r"(?i)draw(?:l|al)\s*[:\-]?\s*(\d+(?:\.\d+)?)")


def categories(c: Column) -> dict[str, Column]:
    """Five booleans of the technologies that a text names."""
    low = F.lower(F.coalesce(c, F.lit("")))
    has = lambda *words: reduce(lambda a, b: a | b, [low.contains(w) for w in words])
    return {"solar": has("solar"), "wind": has("wind"), "ess": has("ess", "energy storage"), "hydro": has("hydro", "pump", "psp"), "hybrid": has("hybrid")}


def bay_numbers(c: Column) -> Column:
    """Distinct bay numbers that a scope text names, voltages left out."""
    lists = F.concat(*[all_groups(F.coalesce(c, F.lit("")), p, 1) for p in BAY_PATTERNS])
    tokens = F.flatten(F.transform(lists, lambda x: F.transform(all_groups(x, r"(?i)[A-Z]?\d+[A-Z]?"), F.upper)))
    return F.array_join(F.array_distinct(F.filter(tokens, lambda x: ~x.isin("220", "400", "765"))), " | ")


def contains_either(a: Column, b: Column) -> Column:
    x, y = normalize(a), normalize(b)
    return (x != "") & (y != "") & (x.contains(y) | y.contains(x))


def is_effective(c: Column) -> Column:
    t = normalize(c)
    return t.contains("effective") & ~t.rlike(r"\bnot\s+effective\b|\bnon[\s-]?effective\b")


def is_pending(c: Column) -> Column:
    return (normalize(c) != "") & ~is_effective(c)


def voltages_in(c: Column) -> Column:
    return all_groups(c, r"(?i)\b(\d{2,3})\s*kV\b", 1)


def best_voltage(found: Column) -> Column:
    """The most frequent standard value, of equal ones the first seen; else the most frequent value of all."""
    standard = F.filter(found, lambda x: x.isin(*STANDARD_VOLTAGES))
    pool = F.when(F.size(standard) > 0, standard).otherwise(found)
    ranked = F.array_sort(F.transform(F.array_distinct(pool), lambda v: F.struct((-F.size(F.filter(pool, lambda x: x == v))).alias("n"), F.array_position(pool, v).alias("at"), v.alias("v"))))
    return F.concat(F.get(ranked, 0)["v"], F.lit(" kV"))


#: The cells of a row that are searched for a voltage, in this order.
VOLTAGE_CELLS = ("substation_raw", "location_raw", "developer_raw", "mode_raw", "nature_raw", "type_raw")


def voltage_of_row(own: Column, cells: list[Column]) -> Column:
    """The first voltage of the row's own value, else the best one that its cells name."""
    first = F.concat(F.get(voltages_in(own), 0), F.lit(" kV"))
    return F.coalesce(first, best_voltage(voltages_in(F.concat_ws(" ", *cells))))


def to_string(c: Column) -> Column:
    v = F.trim(F.translate(c, "\n", " "))
    return F.when(~v.isin("", "N/A", "null"), v)
