"""Page gates: which columns a page seems to hold, and which pages are never read."""

from __future__ import annotations

from re import _parser

from pyspark.sql import Column
from pyspark.sql import functions as F

from recordweave.functions.text import compact, once
from recordweave.operators.joins import all_of, any_of

#: Patterns of pages that are never read.
BLOCKED = (r"\bGNARE\s+within\s+Region\b", r"\bGNARE\s+outside\s+Region\b", r"\bTotal\s+GNARE\s+Required\b", r"\bStart\s+date\s+of\s+GNARE\b", r"\bEnd\s+date\s+of\s+GNARE\b", r"\bGNARE\b.*\bMW\b")
BLOCKED_TWICE = (r"\bBulk\s+consumer\b", r"\bDrawee\s+entity\b", r"\bDrawee\s+entity\s+connected\b")
#: Header words of each column; a column is there if all words of one variant are.
HEADERS = {
    "project_location": ((r"\bProject\b", r"\bLocation\b"), (r"\bProject\s+Location\b",)),
    "substation": (
        (r"\bConnectivity\b", r"\blocation\b", r"\bApplication\b"), (r"\bNearest\b", r"\bPooling\b", r"\bStation\b"), (r"\bPooling\b", r"\bStation\b", r"\bApplication\b"),
        (r"\bConnectivity\b", r"\bGranted\s+at\b"), (r"\bConnectivity\b", r"\bGranted\b"), (r"\bLocation\b", r"\bGrant\b", r"\bStage\b", r"\bConnectivity\b"),
        (r"\bLocation\s+requested\b", r"\bGrant\b"), (r"\bConnectivity\b", r"\bInjection\s+Point\b"), (r"\bInjection\s+Point\b",), (r"\bsub[\s-]?station\b",),
    ),
    "developer": ((r"\bApplicant\b",), (r"\bName\b", r"\bApplicant\b"), (r"\bName\b", r"\bDeveloper\b"), (r"\bDeveloper\b",)),
    "project_type": ((r"\bType\b", r"\b(?:Source|Generation|Energy|Plant)\b"), (r"\bSource\s+Type\b",), (r"\bGeneration\s+Type\b",), (r"\bEnergy\s+Source\b",)),
    "gna_id": ((r"\bApplication\b", r"\bID\b"), (r"\bApplication\b", r"\bNo\b", r"\bDate\b"), (r"\bGNA\b", r"\bApplication\b"), (r"\bST[\s-]*II\b", r"\bApplication\b"), (r"\bST[\s-]*II\b", r"\bID\b")),
    "lta_id": ((r"\bApp\b", r"\bNo\b", r"\bConn\b", r"\bQuantum\b", r"\bConnectivity\b"), (r"\bLTA\b", r"\bApplication\b"), (r"\bLTA\b", r"\bID\b"), (r"\bLTA\b", r"\bApp\b")),
    "enhancement_id": ((r"\bApplication\b", r"\bID\b", r"\b5\.?2\b"), (r"\bApplication\b", r"\bNo\b", r"\bDate\b", r"\b5\.?2\b"), (r"\benhancement\b", r"\b5\.?2\b"), (r"\brevision\b", r"\bapplication\b", r"\bID\b")),
    "quantum": ((r"\bInstalled\b", r"\bCapacity\b", r"\bMW\b"), (r"\bConnectivity\b", r"\bQuantum\b", r"\bMW\b"), (r"\bApplication\b", r"\bQuantum\b", r"\bMW\b"), (r"\bCapacity\b", r"\bMW\b")),
    "nature": ((r"\bNature\b", r"\bApplicant\b"),),
    "mode": ((r"\bCriterion\b", r"\bapplying\b"), (r"\bCriteria\b", r"\bapplying\b"), (r"\bMode\b", r"\bCriteria\b"), (r"\bMode\b", r"\bapplying\b")),
    "start_date": ((r"\bStart\b", r"\bDate\b", r"\bConnectivity\b", r"\bApplication\b"), (r"\bStart\b", r"\bDate\b", r"\bConnectivity\b"), (r"\bConnectivity\b", r"\bsought\b", r"\bdate\b")),
    "submission_date": ((r"\bApplication\b", r"\bNo\b", r"\bDate\b"), (r"\bSubmission\b", r"\bDate\b"), (r"\bApplication\b", r"\bDate\b")),
    "operational_date": ((r"\bGNA\b", r"\bOperationalization\b"), (r"\bSCoD\b",)),
    "status": ((r"\bWithdrawn\b",), (r"\bgrant(?:ed)?\b",), (r"\bRevoked\b",), (r"\bStatus\b", r"\bApplication\b")),
    "psp_mwh": ((r"\bpump\s*storage\b",), (r"\bPSP\b",)),
}
#: Places and companies whose names mark a cell.
PLACES = (
    "Aligarh", "Amargarh", "Barmer", "Bhadla", "Bikaner", "Fatehgarh", "Kishtwar", "Merta", "Pali", "Ramgarh", "Sanchore", "Ajmer", "Jodhpur", "Jaipur", "Bhilwara", "Kota", "Udaipur",
    "Sikar", "Tonk", "Chittorgarh", "Nagaur", "Jhunjhunu", "Alwar", "Bhiwani", "Hisar", "Mahendragarh", "Narnaul", "Rewari", "Moga", "Bathinda", "Ludhiana", "Amritsar", "Jalandhar", "Anta",
    "Gwalior", "Indore", "Ujjain", "Bhopal", "Rewa", "Raipur", "Bareilly", "Agra", "Kanpur", "Lucknow", "Gorakhpur", "Dharamshala", "Nalagarh", "Parwanoo", "Shimla", "Jammu", "Srinagar",
    "Leh", "Kargil", "Ranchi", "Dhanbad", "Bokaro", "Deoghar", "Patna", "Muzaffarpur", "Bhagalpur", "Kolkata", "Durgapur", "Kharagpur", "Hyderabad", "Warangal", "Vijayawada", "Kurnool",
    "Raichur", "Chennai", "Madurai", "Salem", "Tirunelveli", "Bengaluru", "Mysuru", "Hubballi", "Bellary", "Ahmedabad", "Gandhinagar", "Surat", "Vadodara", "Pune", "Mumbai", "Nagpur",
    "Nashik", "Aurangabad", "Bhubaneswar", "Rourkela", "Cuttack",
)
COMPANIES = (
    "ACME", "Adani", "Tata", "NTPC", "NHPC", "SJVN", "Greenko", "ReNew", "Azure", r"Hero\s+Future", "JSW", "Torrent", "Sembcorp", "Sprng", "Ayana", r"SB\s+Energy", "Avaada", "CleanMax",
    r"Fourth\s+Partner", "Engie", r"O2\s+Power", r"Amp\s+Energy", r"Vikram\s+Solar", r"Sterling\s+Wilson", "Waaree", "Suzlon", "Inox", "THDC", "CESC", "BSES", r"AM\s+Green", r"Altra\s+Xergi",
)
#: A run of words before `(PG)` is bounded, which leaves the number of matches as it is and the matcher's stack shallow.
#: Texts of cells that mark a column; two occurrences make it active.
VALUES = {
    "substation": (r"\b(?:" + "|".join(PLACES) + r")(?:\s*[-‐–]\s*(?:I{1,4}V?|V?I{0,3}|[0-9]+))?\b", r"\b[A-Z][a-z]+(?:\s+[A-Z][a-z]+){0,8}\s*\((?:PG|PGCIL|PS)\)",),
    "developer": (r"\b(?:Private\s+Limited|Pvt\.?\s*Ltd|Limited|LLP|Corporation)\b", r"\b(?:" + "|".join(COMPANIES) + r")\b"),
    "project_type": (r"\bSolar\s*\+?\s*BESS\b", r"\bHybrid\s*\+?\s*BESS\b", r"\bHydro\s*\+?\s*BESS\b", r"\b(?:Solar|Wind|Hybrid|BESS|Hydro|Thermal)\b"),
    "gna_id": (r"\b(?:12|22|11)\d{8}\b", r"\bST[\s-]*II\b"),
    "lta_id": (r"\b(?:04|41)\d{7,8}\b", r"\bLTA\s*:"),
    "mode": (r"\bLand\s+(?:BG\s+)?Route\b", r"\bLOA\s+or\s+PPA\b", r"\b(?:NHPC|NTPC|SJVN|REMCL|SECI|IREDA)\s+LOA\b", r"\bLand\s+Route\b"),
}
#: A pattern that needs one of more texts than these is tried at once.
MOST_TEXTS = 6


def needed(pattern: str) -> tuple[str, ...]:
    """Lower-case texts one of which every match of the pattern holds, whatever its case; none if there is no telling."""

    def of(parts) -> tuple[str, ...]:
        found, run = [], ""
        for kind, value in [*parts, (None, None)]:
            if kind is _parser.LITERAL:
                run += chr(value).lower()
                continue
            found, run = found + ([(run,)] if run else []), ""
            if kind is _parser.SUBPATTERN:
                found.append(of(value[3]))
            elif kind is _parser.MAX_REPEAT and value[0] > 0:
                found.append(of(value[2]))
            elif kind is _parser.BRANCH:
                each = [of(x) for x in value[1]]
                found.append(tuple(t for x in each for t in x) if all(each) else ())
        return max(found, key=lambda x: min(map(len, x), default=0), default=())

    return of(_parser.parse(pattern))


def by_first_letter(pattern: str) -> str:
    """The same pattern, its lists of names parted by their first letters: a matcher tries a letter once, not each name."""
    for names in (PLACES, COMPANIES):
        groups: dict[str, list[str]] = {}
        for n in names:
            groups.setdefault(n[0].lower(), []).append(n[1:])
        pattern = pattern.replace("|".join(names), "|".join(f"{k}(?:{'|'.join(v)})" for k, v in groups.items()))
    return pattern


class Page:
    """A page's text, and its lower-case form, in which texts that a pattern needs are looked for before the pattern is."""

    def __init__(self, text: Column, low: Column):
        self.text, self.low = text, low

    def may(self, pattern: str) -> Column | None:
        texts = needed(pattern)
        return any_of([self.low.contains(x) for x in texts]) if 0 < len(texts) <= MOST_TEXTS else None

    def holds(self, pattern: str) -> Column:
        may, found = self.may(pattern), self.text.rlike("(?i)" + by_first_letter(pattern))
        return found if may is None else may & found

    def count(self, pattern: str) -> Column:
        may, n = self.may(pattern), F.regexp_count(self.text, F.lit("(?i)" + by_first_letter(pattern)))
        return n if may is None else F.when(may, n).when(self.text.isNotNull(), 0)

    def headers(self) -> list[Column]:
        return [F.when(any_of([all_of([self.holds(w) for w in v]) for v in variants]), F.lit(name)) for name, variants in HEADERS.items()]

    def has_values(self, name: str, least: int) -> Column:
        return sum((self.count(p) for p in VALUES[name]), F.lit(0)) >= least

    def values(self, least: int) -> list[Column]:
        return [F.when(self.has_values(name, least), F.lit(name)) for name in VALUES]

    def blocked(self) -> Column:
        return any_of([self.holds(p) for p in BLOCKED] + [self.count(p) >= 2 for p in BLOCKED_TWICE])


def _page(text: Column, use) -> Column:
    return once(F.struct(text.alias("text"), F.lower(text).alias("low")), lambda x: use(Page(x["text"], x["low"])))


def _listed(names: list[Column]) -> Column:
    return F.array_sort(F.array_compact(F.array(*names)))


def header_columns(text: Column) -> Column:
    """Sorted names of the columns whose headers a page has."""
    return _page(text, lambda p: _listed(p.headers()))


def value_columns(text: Column, least: int = 2) -> Column:
    return _page(text, lambda p: _listed(p.values(least)))


def has_values(text: Column, name: str, least: int = 2) -> Column:
    """Whether value_columns has this name; the other columns' patterns are not tried."""
    return _page(text, lambda p: F.coalesce(p.has_values(name, least), F.lit(False)))


def is_blocked(text: Column) -> Column:
    return _page(text, lambda p: p.blocked())


def active_columns(text: Column) -> Column:
    return _page(text, lambda p: F.when(p.blocked(), F.array().cast("array<string>")).otherwise(F.array_sort(F.array_distinct(F.array_compact(F.array(*p.headers(), *p.values(2)))))))


def passes(text: Column, min_columns: int = 1) -> Column:
    return F.size(active_columns(text)) >= min_columns


def has_all(text: Column, words: tuple[str, ...]) -> Column:
    return all_of([text.contains(w) for w in words])


def has_all_compact(text: Column, words: tuple[str, ...]) -> Column:
    low, tight = F.lower(text), compact(text)
    return all_of([low.contains(w.lower()) | tight.contains("".join(ch for ch in w.lower() if ch.isalnum())) for w in words])
