"""Enrichment jobs: each is one lazy DataFrame plan made of the column functions and operators."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from recordweave.functions import numbers as V
from recordweave.functions import text as T
from recordweave.operators import joins as J
from recordweave.operators import ordering as R

c = F.col
#: Applicants whose rows are never used.
NATURE_BLOCKED = ("bulk consumer", "drawee entity", "drawee entity connected")
ENTRY_ORDER = ["source_file", "pos", "tie1", "tie2", "solar_mw", "expected_date_raw"]


# --- rows of applications -------------------------------------------------------------------------------------------
def has_key(*ids: Column) -> Column:
    return F.coalesce(*[T.clean(i) for i in ids]).isNotNull()


def nature_blocked(nature: Column) -> Column:
    low = F.lower(T.clean(nature))
    return F.coalesce(J.any_of([low.contains(w) for w in NATURE_BLOCKED]), F.lit(False))


def valid_row(gna: Column, lta: Column, enh: Column, nature: Column) -> Column:
    return has_key(gna, lta, enh) & ~nature_blocked(nature)


def registry(as_of: Column) -> dict[str, Column]:
    """Output column -> expression over the raw columns; a new column is one more entry."""
    gna, lta, enh = c("gna_raw"), c("lta_raw"), c("enh_raw")
    op = V.date_text(c("op_date_raw"))
    return {
        "developer": T.developer(c("developer_raw")),
        "gna_id": T.numeric_ids(gna),
        "lta_id": T.numeric_ids(lta, True),
        "enhancement_id": T.enhancement_id(enh, gna, lta, c("mode_raw")),
        "mode": T.mode_bucket(c("mode_raw")),
        "nature": T.clean(c("nature_raw")),
        "status": T.status(c("status_raw")),
        "project_location": T.clean(c("location_raw")),
        "state": T.state(c("location_raw")),
        "project_type": T.project_type(c("type_raw")),
        "voltage_level": T.voltage_text(c("voltage_raw")),
        "gna_operational_date": op,
        "gna_operational_flag": V.in_future(V.parse_date(op), as_of),
        "substation": T.clean(c("substation_raw")),
        "applied_quantum_mw": T.clean(c("quantum_raw")),
        "granted_quantum_mw": T.clean(c("granted_raw")),
        "submission_date": V.date_text(c("submitted_raw")),
        "start_date": V.date_text(c("start_raw")),
        "added_date": V.date_text(c("added_raw")),
        **dict(zip(("psp_mwh", "psp_injection_mw", "psp_drawl_mw"), stored(T.pump_storage, ["psp_mwh_raw", "psp_injection_raw", "psp_drawl_raw"], c("mode_raw")))),
        **dict(zip(("battery_mwh", "battery_injection_mw", "battery_drawl_mw"), stored(T.battery, ["battery_mwh_raw", "battery_injection_raw", "battery_drawl_raw"], c("mode_raw"), c("type_raw")))),
    }


def stored(rule, raw: list[str], *context: Column) -> list[Column]:
    """The values that a rule finds in the raw columns and their context, else the raw values."""
    return [T.clean(F.coalesce(T.none_if_empty(found), c(x))) for found, x in zip(rule(*[c(x) for x in raw], *context), raw)]


def normalise(rows: DataFrame, as_of: Column) -> DataFrame:
    """Valid rows with the registry's columns; rows whose identifiers vanish when normalised go."""
    ok = rows.filter(valid_row(c("gna_raw"), c("lta_raw"), c("enh_raw"), c("nature_raw")))
    out = ok.select("row_id", "source_pdf", "page_number", *[e.alias(k) for k, e in registry(as_of).items()])
    return out.filter(F.coalesce("gna_id", "lta_id", "enhancement_id").isNotNull())


# --- effectiveness --------------------------------------------------------------------------------------------------
def id_columns() -> list[tuple[str, Column]]:
    gna, lta, enh = c("gna_raw"), c("lta_raw"), c("enh_raw")
    return [("GNA", T.ids_by_space(T.numeric_ids(gna))), ("LTA", T.ids_by_space(T.numeric_ids(lta, True))), ("5.2", T.ids_by_space(T.enhancement_id(enh, gna, lta, c("mode_raw"))))]


def latest_effectiveness(rows: DataFrame) -> DataFrame:
    """The last record of each identifier, by file name and position."""
    return R.first_per(rows.filter("application_id <> ''"), ["application_id"], [F.desc(x) for x in ENTRY_ORDER])


def match_effectiveness(apps: DataFrame, rows: DataFrame) -> DataFrame:
    """Every application with its record, looked up once; later jobs share the match."""
    return J.id_cascade(apps, latest_effectiveness(rows), id_columns())


def overwrite(base: Column, new: Column) -> Column:
    return F.when(T.is_valid(new), new).otherwise(base)


def merge_effectiveness(m: DataFrame) -> DataFrame:
    """Valid values of the record overwrite the application's; region, project type and MW columns are the record's."""
    total = sum((F.coalesce(c(x), F.lit(0.0)) for x in ("solar_mw", "wind_mw", "ess_mw", "hydro_mw")), F.lit(0.0))
    hybrid = T.categories(c("type_of_project"))["hybrid"] & (total > 0)
    return m.withColumns({
        "developer": overwrite(c("developer_raw"), c("name_of_applicant")), "merged_substation": overwrite(c("substation_raw"), c("substation")), "merged_state": overwrite(T.state(c("location_raw")), c("state")),
        "quantum": overwrite(c("quantum_raw"), c("installed_capacity_raw")), "merged_region": F.when(T.is_valid(c("region")), c("region")), "merged_type": F.when(T.is_valid(c("type_of_project")), c("type_of_project")), "hybrid_mw": F.when(hybrid, total),
    })


def operational_date(m: DataFrame, as_of: Column) -> DataFrame:
    """The later of both dates; only the first two identifier columns count here."""
    theirs = F.when(c("match_source").isin("GNA", "LTA"), V.parse_date(c("expected_date_raw")))
    d = V.later(V.parse_date(c("op_date_raw")), theirs)
    return m.withColumns({"op_date": V.format_date(d), "op_flag": V.in_future(d, as_of)})


def additional_date(m: DataFrame) -> DataFrame:
    return m.withColumn("added_date", V.format_date(V.later(V.parse_date(c("op_date_raw")), V.parse_date(c("expected_date_raw")))))


def breakup_capacity(m: DataFrame) -> DataFrame:
    """MW by technology: the record's plus those in the type text; hybrid sums all where several technologies meet."""
    zero = lambda x: F.coalesce(x, F.lit(0.0))
    m = m.withColumn("tech_", V.technology_struct(c("type_raw")))
    tech, cats = {k: c(f"tech_.{k}") for k in V.CATEGORIES}, T.categories(c("type_of_project"))
    eff = {"solar": c("solar_mw"), "wind": c("wind_mw"), "ess": c("ess_mw"), "hydro": c("hydro_mw")}
    eff_all = sum((F.greatest(zero(v), F.lit(0.0)) for v in eff.values()), F.lit(0.0))
    text_all = sum((zero(v) for v in tech.values()), F.lit(0.0))
    several = sum((v.cast("int") for v in cats.values()), F.lit(0)) > 1
    hybrid = F.when(cats["hybrid"] | several, eff_all + text_all).when(tech["hybrid"].isNotNull(), eff_all + tech["hybrid"]).otherwise(0.0)
    some = lambda x: F.when(x > 0, x)
    on = c("match_source").isNotNull()
    return m.withColumns({"solar": F.when(on, some(zero(eff["solar"]) + zero(tech["solar"]))), "wind": F.when(on, some(zero(eff["wind"]) + zero(tech["wind"]))), "hydro": F.when(on, some(zero(eff["hydro"]) + zero(tech["hydro"]))), "hybrid": F.when(on, some(hybrid))}).drop("tech_")


def match_statistics(m: DataFrame) -> DataFrame:
    return m.groupBy(F.coalesce("match_source", F.lit("unmatched")).alias("match_source")).agg(F.count("*").alias("n_rows"))


def job_counters() -> list[Column]:
    """The mapping job's counters: rows by match, dates updated, kept or missing, capacities computed or skipped."""
    base, theirs = V.parse_date(c("op_date_raw")), V.parse_date(c("expected_date_raw"))
    matched = c("match_source").isNotNull()
    some = J.any_of([c(x).isNotNull() for x in ("solar", "wind", "hydro", "hybrid")])
    n = lambda x, name: F.count_if(F.coalesce(x, F.lit(False))).alias(name)
    return [
        *[n(c("match_source") == k, f"matched_{k.lower().replace('.', '')}") for k in ("GNA", "LTA", "5.2")], n(~matched, "unmatched"), F.count("*").alias("total_rows"),
        n(matched & (theirs > F.coalesce(base, F.lit("0001-01-01").cast("date"))), "dates_updated"), n(matched & base.isNotNull() & (theirs.isNull() | (theirs <= base)), "dates_kept"), n(matched & base.isNull() & theirs.isNull(), "no_date"),
        n(matched & some, "computed"), n(~matched, "skipped"),
    ]


def job_statistics(m: DataFrame) -> DataFrame:
    """One row of the mapping job's counters."""
    return m.agg(*job_counters())


def mapping(apps: DataFrame, rows: DataFrame, as_of: Column) -> DataFrame:
    return breakup_capacity(additional_date(operational_date(merge_effectiveness(match_effectiveness(apps, rows)), as_of)))


# --- coordination ---------------------------------------------------------------------------------------------------
def gna_mw(status: Column, schedule: Column) -> Column:
    return F.when(T.is_effective(status), V.total(V.all_mw(schedule)))


def tgna_mw(status: Column, schedule: Column) -> Column:
    return F.when(T.is_pending(status), V.total(V.commissioned_mw(schedule)))


def map_coordination(matches: DataFrame, rows: DataFrame) -> DataFrame:
    out = matches.join(rows, "row_idx")
    return out.withColumns({"gna": gna_mw(c("status_text"), c("schedule_text")), "tgna": tgna_mw(c("status_text"), c("schedule_text")), "bay_no": T.bay_numbers(c("scope_text"))})


def coordination_layer(records: DataFrame, rows: DataFrame) -> DataFrame:
    """Per distinct applicant, substation and identifier the best coordination row, with its capacities; unmatched ones stay."""
    sub, name = (F.coalesce(F.trim(c(x)), F.lit("")) for x in ("substation", "name_of_applicant"))
    left = records.select("application_id", sub.alias("substation"), name.alias("developer")).filter("application_id <> '' or substation <> '' or developer <> ''")
    # capacities are worked out once for each row, not for each record that takes it
    rows = J.staged(rows.select("row_idx", "connectivity_applicant", "pooling_station", gna_mw(c("status_text"), c("schedule_text")).alias("gna"), tgna_mw(c("status_text"), c("schedule_text")).alias("tgna")))
    out = J.best_of_one_id(left, rows, ["connectivity_applicant", "pooling_station"])
    own = lambda x, theirs: F.coalesce(T.none_if_empty(c(x)), c(theirs)).alias(x)
    left_id = F.concat_ws("|", "application_id", "developer", "substation").alias("left_id")
    return out.select(left_id, "row_idx", "id_hits", F.round("score", 9).alias("score"), own("developer", "connectivity_applicant"), own("substation", "pooling_station"), "gna", "tgna")


# --- pages ----------------------------------------------------------------------------------------------------------
#: Words that are counted to tell the class of a meeting.
GNA_WORDS = (r"\bGNA\b", r"\bST[\s-]*II\b", r"\bStage[\s-]*II\b", r"\bGNA/ST\s*II\b")
LTA_WORDS = (r"\bLTA\b", r"\bLong\s+Term\s+Access\b")


def scan_pages(pages: DataFrame, most: int = 10) -> DataFrame:
    """Pages up to number `most`; -1 for all. The filter reaches the scan."""
    return pages if most < 0 else pages.filter(c("page_number") <= most)


def keyword_counts(pages: DataFrame) -> DataFrame:
    """(source_pdf, gna, lta): occurrences over all pages, counted page by page."""
    n = lambda words: F.sum(sum((F.regexp_count("text", F.lit("(?i)" + w)) for w in words), F.lit(0))).cast("long")
    return pages.groupBy("source_pdf").agg(n(GNA_WORDS).alias("gna"), n(LTA_WORDS).alias("lta"))


def keyword_class(gna: Column, lta: Column) -> Column:
    return F.when(lta == 0, "GNA").when(gna == 0, "LTA").when(gna >= lta * 0.3, "GNA").otherwise("LTA")


def meetings(pages: DataFrame) -> DataFrame:
    """One row for each document: number and date from its first page (the date from its second, if need be), and the class."""
    first = F.min_by(F.struct(V.meeting_number(c("text")).alias("number"), V.meeting_date(c("text")).alias("date")), c("page_number"))
    second = pages.withColumn("k", F.row_number().over(R.Window.partitionBy("source_pdf").orderBy("page_number"))).filter("k = 2").select("source_pdf", V.meeting_date(c("text")).alias("second"))
    out = pages.groupBy("source_pdf").agg(first.alias("f")).join(keyword_counts(pages), "source_pdf").join(second, "source_pdf", "left")
    cls, date = keyword_class(c("gna"), c("lta")), F.coalesce("f.date", "second")
    on = lambda k, v: F.when(cls == k, v)
    return out.select("source_pdf", on("GNA", c("f.number")).alias("gna_approved"), on("GNA", date).alias("gna_meeting_date"), on("LTA", c("f.number")).alias("lta_approved"), on("LTA", date).alias("lta_meeting_date"))


def with_meetings(rows: DataFrame, found: DataFrame) -> DataFrame:
    """rows with the columns of their document; one small row for each document, so the check usually allows a broadcast."""
    return rows.join(J.checked_broadcast(found), "source_pdf", "left")


#: Words near which a voltage counts, and voltages.
CONTEXT = re.compile(r"voltage|connectivity|sub[\s-]?station|bus|level", re.I)
VOLTAGE = re.compile(r"\b(\d{2,3})\s*kV\b", re.I)


def voltage_near_context(text: str | None, reach: int = 80) -> str | None:
    """The most frequent voltage within `reach` characters of a context word, else of the whole page."""
    if not text:
        return None
    near = [v for m in CONTEXT.finditer(text) for v in VOLTAGE.findall(text[max(0, m.start() - reach) : m.end() + reach])]
    found = near or VOLTAGE.findall(text)
    pool = [v for v in found if v in T.STANDARD_VOLTAGES] or found
    return f"{Counter(pool).most_common(1)[0][0]} kV" if pool else None


@F.pandas_udf(StringType())
def page_voltage(texts: pd.Series) -> pd.Series:
    """Windows overlap and repeat matches, which built-in functions can't count."""
    return texts.map(voltage_near_context)


def chunk_steps(lengths: np.ndarray, most: int) -> pd.DataFrame:
    """What pages of these lengths make of an open chunk: for sizes up to `upto` (ascending), the size that is open at
    their end and how many chunks were closed on the way.

    A chunk of size s is first cut before the page that brings it over `most`; from there on s no longer matters. So
    there is one step for each page that can be the first cut, and neighbours that end alike are one step.
    """
    m, total = len(lengths), np.r_[0, np.cumsum(lengths)]
    # next_[j]: the page that closes a chunk begun with page j, m if none does; empty chunks are never closed
    over, some = np.searchsorted(total[1:], total[:-1] + most, "right"), np.searchsorted(total, total[:-1], "right")
    next_ = np.minimum(np.maximum(over, some), m)
    open_, closed = np.zeros(m + 1, np.int64), np.zeros(m + 1, np.int64)
    for j in range(m - 1, -1, -1):
        k = next_[j]
        open_[j], closed[j] = (total[m] - total[j], 0) if k == m else (open_[k], closed[k] + 1)
    # s > 0 is cut at page j where most - total[j + 1] < s <= most - total[j]; where s passes all pages it grows by them
    rows = [(0, int(open_[0]), int(closed[0]), False)] + ([(most - int(total[m]), int(total[m]), 0, True)] if total[m] < most else [])
    for j in range(m - 1, -1, -1):
        upto = most - int(total[j]) if j else 1 << 62
        if upto > max(0, most - int(total[j + 1])):
            rows.append((upto, int(open_[j]), int(closed[j]) + 1, False))
    out = pd.DataFrame(rows, columns=["upto", "open", "closed", "grows"])
    like_next = (out[["open", "closed", "grows"]] == out[["open", "closed", "grows"]].shift(-1)).all(axis=1) & (out["upto"] > 0)
    return out[~like_next]


def document_chunks(pages: DataFrame, most: int = 10_000, rows: int = 20_000) -> DataFrame:
    """(source_pdf, chunk_no, first_page, chunk): pages joined in order into chunks of at most `most` characters.

    A chunk closes when one more page would pass `most`. Pages are dealt by range, so a long document is walked by many
    tasks: each range of pages first tells what it makes of a chunk that is open at its start (chunk_steps), the steps
    of a document's ranges are followed one after another, and then all ranges are walked with the chunk that is open.
    """
    cut = R.in_ranges(pages.select("source_pdf", c("page_number").cast("long").alias("page_number"), F.coalesce("text", F.lit("")).alias("text")), ["source_pdf", "page_number", "text"], rows)

    def steps(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("seq_")
        return chunk_steps(group["size"].to_numpy(), most).assign(source_pdf=group["source_pdf"].iloc[0], part_=group["part_"].iloc[0])

    def follow(group: pd.DataFrame) -> pd.DataFrame:
        size = no = 0
        out = []
        for part, step in group.sort_values(["part_", "upto"]).groupby("part_"):
            out.append((group["source_pdf"].iloc[0], part, size, no))
            at = step.iloc[int(np.searchsorted(step["upto"].to_numpy(), size))]
            size, no = (size + int(at["open"]) if at["grows"] else int(at["open"])), no + int(at["closed"])
        return pd.DataFrame(out, columns=["source_pdf", "part_", "size", "no"])

    def walk(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("seq_")
        size, no, out = int(group["size"].iloc[0]), int(group["no"].iloc[0]), []
        doc, part = group["source_pdf"].iloc[0], group["part_"].iloc[0]
        first, parts = None, []
        for page, text in zip(group["page_number"], group["text"]):
            if size and size + len(text) > most:
                out.append((doc, no, part, first, "".join(parts)))
                size, no, first, parts = 0, no + 1, None, []
            if not size:
                first = page
            parts.append(text)
            size += len(text)
        out.append((doc, no, part, first, "".join(parts)))
        return pd.DataFrame(out, columns=["source_pdf", "chunk_no", "part_", "first_page", "text"]).astype({"first_page": "Int64"})

    by = ["source_pdf", "part_"]
    made = cut.select(*by, "seq_", F.length("text").cast("long").alias("size")).groupBy(*by).applyInPandas(steps, "upto long, open long, closed long, grows boolean, source_pdf string, part_ int")
    states = made.groupBy("source_pdf").applyInPandas(follow, "source_pdf string, part_ int, size long, no int")
    pieces = cut.join(states, by).groupBy(*by).applyInPandas(walk, "source_pdf string, chunk_no int, part_ int, first_page long, text string")
    # a chunk that spans ranges is put together; only where its first filled page is, it has a first page that counts
    parts = F.array_sort(F.collect_list(F.struct("part_", "text")))
    chunk = F.array_join(F.transform(parts, lambda x: x["text"]), "")
    first = F.min_by("first_page", F.struct((F.length("text") == 0), F.col("part_")))
    return pieces.groupBy("source_pdf", "chunk_no").agg(first.alias("first_page"), chunk.alias("chunk")).filter("chunk <> ''").select("source_pdf", "chunk_no", "first_page", "chunk")


# --- stored answers -------------------------------------------------------------------------------------------------
ANSWER_ROW = "gna_id string, type string, quantum string"
#: The producer's keys and their columns.
KEYS = {"gna_id": "gna_raw", "type": "type_raw", "quantum": "applied_quantum_mw"}


def answer_json(answer: Column) -> Column:
    """The JSON text of an answer: without its fence, else the first bracketed part."""
    bare = F.trim(F.regexp_replace(answer, r"(?i)^\s*```(?:json)?\s*|\s*```\s*$", ""))
    return F.when(bare.rlike(r"^[{\[]"), bare).otherwise(T.first_group(answer, r"(?s)(\{.*\}|\[.*\])"))


def answer_rows(answers: DataFrame) -> DataFrame:
    """One row for each record of each answer; answers without JSON give none."""
    text = answer_json(c("answer"))
    listed = F.when(text.startswith("["), F.from_json(text, f"array<struct<{ANSWER_ROW.replace(' string', ':string')}>>")).otherwise(F.from_json(text, f"rows array<struct<{ANSWER_ROW.replace(' string', ':string')}>>")["rows"])
    return answers.select("source_pdf", "page_number", F.posexplode(listed).alias("row_idx", "r")).select("source_pdf", "page_number", "row_idx", "r.*").withColumnsRenamed(KEYS)


def extract(pages: DataFrame, extractor, schema: str) -> DataFrame:
    """Rows that a user's function makes of the pages that pass the gate: iterator of frames in, iterator of frames out."""
    return pages.mapInPandas(extractor, schema)
