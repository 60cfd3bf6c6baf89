"""Registered queries over the driver tables, with the SQL that each must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recordweave import oracle as O
from recordweave.functions import names as N
from recordweave.functions import numbers as V
from recordweave.functions import text as T
from recordweave.operators import joins as J
from recordweave.operators import ordering as R
from recordweave.plans import gates as G
from recordweave.plans import jobs
from recordweave.sources import adapters as A

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = sql
        return f

    return add


def columns(name: str, view: str, id_: str, made: dict[str, tuple]) -> None:
    """Register a query that shows columns of a view: alias -> (maker of the Spark column, SQL text)."""
    sql = f"{O.views(view)} SELECT {id_}, " + ", ".join(f"{s} AS {k}" for k, (_, s) in made.items()) + f" FROM {view}"
    query(name, sql)(lambda spark, sf: A.view(spark, sf, view).select(id_, *[make().alias(k) for k, (make, _) in made.items()]))


c = F.col
# --- scalar functions on applications -------------------------------------------------------------------------------
columns("c1_c24_clean", "applications", "row_id", {x: (lambda x=x: T.clean(c(x)), O.clean(x)) for x in ("mode_raw", "status_raw", "gna_raw")})
columns("c8_c9_c10_numeric_ids", "applications", "row_id", {
    "gna_id": (lambda: T.numeric_ids(c("gna_raw")), O.numeric_ids("gna_raw")), "lta_id": (lambda: T.numeric_ids(c("lta_raw"), True), O.numeric_ids_strip("lta_raw")),
    "n_ids": (lambda: F.size(T.long_numbers(c("gna_raw"))).cast("long"), f"len({O.long_numbers('gna_raw')})"),
})
columns("c11_enhancement_id", "applications", "row_id", {"enhancement_id": (
    lambda: T.enhancement_id(c("enh_raw"), c("gna_raw"), c("lta_raw"), c("mode_raw")), f"CASE WHEN enh_raw IS NOT NULL THEN {O.long_numbers('enh_raw')}[1] END")})
columns("c12_w14_state", "applications", "row_id", {"state": (lambda: T.state(c("location_raw")), O.state("location_raw"))})
columns("c13_status", "applications", "row_id", {"status": (lambda: T.status(c("status_raw")), O.status("status_raw"))})
columns("c14_developer", "applications", "row_id", {"developer": (lambda: T.developer(c("developer_raw")), O.developer("developer_raw")), "mode_as_name": (lambda: T.developer(c("mode_raw")), O.developer("mode_raw"))})
columns("c15_mode", "applications", "row_id", {"mode": (lambda: T.mode_bucket(c("mode_raw")), O.mode_bucket("mode_raw"))})
columns("c16_project_type", "applications", "row_id", {"project_type": (lambda: T.project_type(c("type_raw")), O.project_type("type_raw"))})
columns("c17_voltage_text", "applications", "row_id", {"voltage": (lambda: T.voltage_text(c("voltage_raw")), O.voltage_text("voltage_raw"))})
columns("c18_voltage_key", "applications", "row_id", {"voltage_key": (lambda: T.voltage_key(c("voltage_raw")), O.voltage_key("voltage_raw"))})
columns("c21_name_key", "applications", "row_id", {"name_key": (lambda: T.name_key(c("developer_raw")), O.name_key("developer_raw"))})
columns("c25_categories", "effectiveness", "pos", {k: (lambda k=k: T.categories(c("type_of_project"))[k], s) for k, s in zip(("solar", "wind", "ess", "hydro", "hybrid"), (
    "contains(lower(type_of_project), 'solar')", "contains(lower(type_of_project), 'wind')", "contains(lower(type_of_project), 'ess') OR contains(lower(type_of_project), 'energy storage')",
    "contains(lower(type_of_project), 'hydro') OR contains(lower(type_of_project), 'pump') OR contains(lower(type_of_project), 'psp')", "contains(lower(type_of_project), 'hybrid')"))})
columns("c37_date_text", "applications", "row_id", {"op_date": (lambda: V.date_text(c("op_date_raw")), O.date_text("op_date_raw"))})
columns("c38_c39_parse_date", "effectiveness", "pos", {"expected": (lambda: V.parse_date(c("expected_date_raw")).cast("string"), f"CAST({O.parse_date('expected_date_raw')} AS VARCHAR)"), "shown": (lambda: V.format_date(V.parse_date(c("expected_date_raw"))), f"strftime({O.parse_date('expected_date_raw')}, '%d.%m.%Y')")})
columns("c40_c41_later_and_future", "applications", "row_id", {
    "later": (lambda: V.later(V.parse_date(c("op_date_raw")), F.lit("1995-06-15").cast("date")).cast("string"), f"CAST(greatest({O.parse_date('op_date_raw')}, DATE '1995-06-15') AS VARCHAR)"),
    "flag": (lambda: V.in_future(V.parse_date(c("op_date_raw")), F.lit("1995-06-15").cast("date")), f"CASE WHEN {O.parse_date('op_date_raw')} > DATE '1995-06-15' THEN 'Yes' WHEN {O.parse_date('op_date_raw')} IS NOT NULL THEN 'No' END"),
})
columns("c34_c35_c36_numbers", "effectiveness", "pos", {
    "capacity": (lambda: V.number_or_null(c("installed_capacity_raw")), "try_cast(replace(installed_capacity_raw, ',', '') AS DOUBLE)"),
    "or_zero": (lambda: V.number_or_zero(c("expected_date_raw")), "coalesce(try_cast(replace(expected_date_raw, ',', '') AS DOUBLE), 0.0)"),
    "number_like": (lambda: V.is_number_like(c("application_id")), "regexp_matches(application_id, '^\\d+(?:\\.\\d+)?$')"),
})
columns("c33_to_string", "effectiveness", "pos", {"expected": (lambda: T.to_string(c("expected_date_raw")), "CASE WHEN trim(expected_date_raw) NOT IN ('', 'N/A', 'null') THEN trim(expected_date_raw) END")})
columns("c2_c3_c4_c5_normal_forms", "coordination", "row_idx", {
    "squeezed": (lambda: T.squeeze(c("connectivity_applicant")), O.squeeze("connectivity_applicant")), "compact": (lambda: T.compact(c("connectivity_applicant")), "regexp_replace(lower(connectivity_applicant), '[^a-z0-9]+', '', 'g')"),
    "normal": (lambda: T.normalize(c("connectivity_applicant")), f"lower({O.squeeze('connectivity_applicant')})"), "id": (lambda: T.normalize_id(c("connectivity_applicant")), O.normalize_id("connectivity_applicant")),
})
columns("c6_c7_split_ids", "applications", "row_id", {
    "by_space": (lambda: F.array_join(T.ids_by_space(c("gna_raw")), "|"), f"array_to_string({O.ids_by_space('gna_raw')}, '|')"),
    "by_mark": (lambda: F.array_join(T.ids_by_mark(c("gna_raw")), "|"), "array_to_string(list_filter(list_transform(string_split_regex(coalesce(gna_raw, ''), '[;,|\\n]+'), lambda x: trim(x)), lambda x: x <> ''), '|')"),
})
columns("c22_pump_storage", "page_text", "page_number", {k: (lambda i=i: T.pump_storage(c("text"))[i], s) for i, k, s in zip(range(3), ("mwh", "injection", "drawl"), (
    "CASE WHEN regexp_matches(text, '(?i)\\b(pump\\s*storage|psp)\\b') THEN coalesce(nullif(regexp_extract(text, '(?i)for\\s+(\\d+(?:\\.\\d+)?)\\s*(?:MWh|MW)', 1), ''), nullif(regexp_extract(text, '(?i)(\\d+(?:\\.\\d+)?)\\s*MWh', 1), '')) END",
    "CASE WHEN regexp_matches(text, '(?i)\\b(pump\\s*storage|psp)\\b') THEN nullif(regexp_extract(text, '(?i)(?:max\\s*)?injection\\s*[:\\-]?\\s*(\\d+(?:\\.\\d+)?)', 1), '') END",
    "CASE WHEN regexp_matches(text, '(?i)\\b(pump\\s*storage|psp)\\b') THEN nullif(regexp_extract(text, '(?i)(?:max\\s*)?(?:drawl|drawal)\\s*[:\\-]?\\s*(\\d+(?:\\.\\d+)?)', 1), '') END"))})
columns("c23_battery", "applications", "row_id", {"battery_mwh": (
    lambda: T.battery(c("enh_raw"), c("lta_raw"), c("gna_raw"), c("type_raw"))[0], f"CASE WHEN regexp_matches(concat_ws(' ', coalesce(enh_raw, ''), coalesce(lta_raw, ''), coalesce(gna_raw, ''), type_raw), '(?i)\\b(bess|battery|ess)\\b') THEN {O.clean('enh_raw')} END")})
columns("c27_bay_numbers", "coordination", "row_idx", {"bays": (lambda: T.bay_numbers(c("scope_text")), O.bay_numbers("scope_text"))})
columns("c28_a9_mw", "coordination", "row_idx", {"n": (lambda: F.size(V.all_mw(c("schedule_text"))).cast("long"), "len(regexp_extract_all(schedule_text, '(?i)([\\d,]+\\.?\\d*)\\s*MW', 1))"), "total": (lambda: V.total(V.all_mw(c("schedule_text"))), O.mw_total("schedule_text"))})
columns("c29_commissioned", "coordination", "row_idx", {"total": (lambda: V.total(V.commissioned_mw(c("schedule_text"))), O.mw_total("schedule_text", True))})
columns("f19_status_predicates", "coordination", "row_idx", {"effective": (lambda: T.is_effective(c("status_text")), O.is_effective("status_text")), "pending": (lambda: T.is_pending(c("status_text")), f"NOT {O.is_effective('status_text')}")})
columns("e6_gna_tgna", "coordination", "row_idx", {
    "gna": (lambda: jobs.gna_mw(c("status_text"), c("schedule_text")), f"CASE WHEN {O.is_effective('status_text')} THEN {O.mw_total('schedule_text')} END"),
    "tgna": (lambda: jobs.tgna_mw(c("status_text"), c("schedule_text")), f"CASE WHEN NOT {O.is_effective('status_text')} THEN {O.mw_total('schedule_text', True)} END"),
})
_tech = lambda k: V.technology_mw(c("type_raw"))[k]
columns("a11_technology_mw", "applications", "row_id", {
    "solar": (lambda: _tech("solar"), "CASE row_id % 5 WHEN 0 THEN 300.0 WHEN 4 THEN 0.0 END"), "wind": (lambda: _tech("wind"), "CASE row_id % 5 WHEN 2 THEN 12.0 END"),
    "ess": (lambda: _tech("ess"), "CASE row_id % 5 WHEN 2 THEN 19.0 END"), "hybrid": (lambda: _tech("hybrid"), "CASE row_id % 5 WHEN 1 THEN 500.0 END"), "thermal": (lambda: _tech("thermal"), "CASE row_id % 5 WHEN 3 THEN 0.0 END"),
})
columns("f14_f15_f16_row_validation", "applications", "row_id", {
    "has_key": (lambda: jobs.has_key(c("gna_raw"), c("lta_raw"), c("enh_raw")), f"coalesce({O.clean('gna_raw')}, {O.clean('lta_raw')}, {O.clean('enh_raw')}) IS NOT NULL"),
    "blocked": (lambda: jobs.nature_blocked(c("nature_raw")), "contains(lower(nature_raw), 'bulk consumer') OR contains(lower(nature_raw), 'drawee entity')"),
    "valid_row": (lambda: jobs.valid_row(c("gna_raw"), c("lta_raw"), c("enh_raw"), c("nature_raw")), f"coalesce({O.clean('gna_raw')}, {O.clean('lta_raw')}, {O.clean('enh_raw')}) IS NOT NULL AND NOT contains(lower(nature_raw), 'bulk consumer')"),
})
columns("f18_validity", "applications", "row_id", {
    "valid": (lambda: T.is_valid(c("mode_raw")), "coalesce(lower(trim(mode_raw)) NOT IN ('', 'none', 'null', 'na', 'n/a', '-', '--', 'nan'), false)"),
    "blank": (lambda: T.is_blank(c("gna_raw")), "coalesce(lower(trim(gna_raw)) IN ('', 'nan', 'none', 'null'), true)"), "one_digit": (lambda: T.is_single_digit(c("voltage_raw")), "regexp_matches(voltage_raw, '^\\d$')"),
})


# --- gates on pages --------------------------------------------------------------------------------------------------
columns("f3_page_blocklist", "page_text", "page_number", {"blocked": (lambda: G.is_blocked(c("text")), "regexp_matches(text, '(?i)\\bTotal\\s+GNARE\\s+Required\\b') OR regexp_matches(text, '(?i)\\bGNARE\\b.*\\bMW\\b')")})
columns("f1_header_gate", "page_text", "page_number", {
    "location": (lambda: F.array_contains(G.header_columns(c("text")), "project_location"), "regexp_matches(text, '(?i)\\bProject\\b') AND regexp_matches(text, '(?i)\\bLocation\\b')"),
    "nature": (lambda: F.array_contains(G.header_columns(c("text")), "nature"), "regexp_matches(text, '(?i)\\bNature\\b') AND regexp_matches(text, '(?i)\\bApplicant\\b')"),
    "lta": (lambda: F.array_contains(G.header_columns(c("text")), "lta_id"), "(regexp_matches(text, '(?i)\\bLTA\\b') AND (regexp_matches(text, '(?i)\\bApplication\\b') OR regexp_matches(text, '(?i)\\bID\\b') OR regexp_matches(text, '(?i)\\bApp\\b')))"
        " OR (regexp_matches(text, '(?i)\\bApp\\b') AND regexp_matches(text, '(?i)\\bNo\\b') AND regexp_matches(text, '(?i)\\bConn\\b') AND regexp_matches(text, '(?i)\\bQuantum\\b') AND regexp_matches(text, '(?i)\\bConnectivity\\b'))"),
})
columns("f2_value_gate", "page_text", "page_number", {"gna": (lambda: G.has_values(c("text"), "gna_id"), "len(regexp_extract_all(text, '(?i)\\b(?:12|22|11)\\d{8}\\b')) + len(regexp_extract_all(text, '(?i)\\bST[\\s-]*II\\b')) >= 2")})
columns("f5_f6_keyword_gates", "page_text", "page_number", {
    "all_words": (lambda: G.has_all(c("text"), ("Pooling", "Quantum", "Connectivity")), "contains(text, 'Pooling') AND contains(text, 'Quantum') AND contains(text, 'Connectivity')"),
    "compacted": (lambda: G.has_all_compact(c("text"), ("Application ID", "Project Location")), "(contains(lower(text), 'application id') OR contains(regexp_replace(lower(text), '[^a-z0-9]+', '', 'g'), 'applicationid')) AND (contains(lower(text), 'project location') OR contains(regexp_replace(lower(text), '[^a-z0-9]+', '', 'g'), 'projectlocation'))"),
})


@query("f4_page_gate")
def f4(spark, sf):
    """Every page with its active columns; the rule is tested against a plain Python version."""
    return A.view(spark, sf, "page_text").select("page_number", G.active_columns(c("text")).alias("active")).select("page_number", (F.size("active") >= 1).alias("passes"), F.array_join("active", ",").alias("active"))


@query("s1_page_scan", O.views("page_text") + " SELECT source_pdf, count(*) AS pages, max(page_number) AS last_page FROM page_text GROUP BY source_pdf")
def s1(spark, sf):
    return jobs.scan_pages(A.view(spark, sf, "page_text"), -1).groupBy("source_pdf").agg(F.count("*").alias("pages"), F.max("page_number").alias("last_page"))


_count_sql = {"gna": ("\\bGNA\\b", "\\bST[\\s-]*II\\b", "\\bStage[\\s-]*II\\b", "\\bGNA/ST\\s*II\\b"), "lta": ("\\bLTA\\b", "\\bLong\\s+Term\\s+Access\\b")}
_count_sql = {k: " + ".join(f"len(regexp_extract_all(text, '(?i){p}'))" for p in v) for k, v in _count_sql.items()}


@query("a6_a7_keyword_classes", O.views("page_text") + f", n AS (SELECT source_pdf, CAST(sum({_count_sql['gna']}) AS BIGINT) AS gna, CAST(sum({_count_sql['lta']}) AS BIGINT) AS lta FROM page_text GROUP BY source_pdf) "
       "SELECT source_pdf, gna, lta, CASE WHEN lta = 0 THEN 'GNA' WHEN gna = 0 THEN 'LTA' WHEN gna >= lta * 0.3 THEN 'GNA' ELSE 'LTA' END AS class FROM n")  # fmt: skip
def a6(spark, sf):
    n = jobs.keyword_counts(A.view(spark, sf, "page_text"))
    return n.withColumn("class", jobs.keyword_class(c("gna"), c("lta")))


columns("c26_c42_meeting_values", "page_text", "page_number", {
    "meeting": (lambda: V.meeting_number(c("text")), "nullif(regexp_extract(text, '(?i)(\\d{1,3})\\s*(?:st|nd|rd|th)\\s+(?:consulting\\s+meeting|cmets)', 1), '')"),
    "held": (lambda: V.meeting_date(c("text")), "CASE WHEN contains(text, '11th November 2025') THEN '11.11.2025' END"),
})


@query("e11_p9_meeting_columns", O.views("page_text") + f""", n AS (SELECT source_pdf, sum({_count_sql['gna']}) AS gna, sum({_count_sql['lta']}) AS lta,
  arg_min(nullif(regexp_extract(text, '(?i)(\\d{{1,3}})\\s*(?:st|nd|rd|th)\\s+(?:consulting\\s+meeting|cmets)', 1), ''), page_number) AS meeting FROM page_text GROUP BY source_pdf)
SELECT p.source_pdf, page_number, CASE WHEN lta = 0 OR (gna > 0 AND gna >= lta * 0.3) THEN meeting END AS gna_approved, CASE WHEN lta > 0 AND (gna = 0 OR gna < lta * 0.3) THEN meeting END AS lta_approved FROM page_text p JOIN n USING (source_pdf)""")
def e11(spark, sf):
    pages = A.view(spark, sf, "page_text")
    return jobs.with_meetings(pages, jobs.meetings(pages)).select("source_pdf", "page_number", "gna_approved", "lta_approved")


@query("c19_a12_voltage_of_row", O.views("applications") + f" SELECT row_id, nullif(regexp_extract(voltage_raw, '(?i)\\b(\\d{{2,3}})\\s*kV\\b', 1), '') || ' kV' AS voltage FROM applications WHERE NOT regexp_matches(voltage_raw, '\\D220kV')"
       + " UNION ALL SELECT row_id, '220 kV' FROM applications WHERE regexp_matches(voltage_raw, '\\D220kV')")
def c19(spark, sf):
    return A.view(spark, sf, "applications").select("row_id", T.best_voltage(T.voltages_in(F.concat_ws(" ", "voltage_raw", "location_raw"))).alias("voltage"))


@query("c20_voltage_of_page")
def c20(spark, sf):
    """Voltages near a context word, the most frequent first; tested against a plain Python version."""
    return A.view(spark, sf, "page_text").select("page_number", jobs.page_voltage(c("text")).alias("voltage"))


_CHUNKS = O.views("page_text").replace("WITH ", "WITH RECURSIVE ", 1) + """, p AS MATERIALIZED (SELECT source_pdf, page_number, length(text) AS n, row_number() OVER (PARTITION BY source_pdf ORDER BY page_number, text) AS k FROM page_text),
w AS (SELECT source_pdf, k, page_number AS first_page, n AS size, 0 AS chunk_no FROM p WHERE k = 1
  UNION ALL SELECT p.source_pdf, p.k, CASE WHEN w.size = 0 OR w.size + p.n > 10000 THEN p.page_number ELSE w.first_page END, CASE WHEN w.size > 0 AND w.size + p.n > 10000 THEN p.n ELSE w.size + p.n END,
    CASE WHEN w.size > 0 AND w.size + p.n > 10000 THEN w.chunk_no + 1 ELSE w.chunk_no END FROM w JOIN p ON p.source_pdf = w.source_pdf AND p.k = w.k + 1)
SELECT source_pdf, chunk_no, arg_max(first_page, k) AS first_page, CAST(arg_max(size, k) AS INT) AS chars FROM w GROUP BY source_pdf, chunk_no HAVING arg_max(size, k) > 0"""


@query("w12_chunks", _CHUNKS)
def w12(spark, sf):
    chunks = jobs.document_chunks(A.view(spark, sf, "page_text"), 10_000)
    return chunks.select("source_pdf", "chunk_no", "first_page", F.length("chunk").alias("chars"))


# --- linking ---------------------------------------------------------------------------------------------------------
_EFF = ", ranked AS (SELECT *, row_number() OVER (PARTITION BY application_id ORDER BY source_file DESC, pos DESC, tie1 DESC, tie2 DESC, solar_mw DESC, expected_date_raw DESC) AS r FROM effectiveness WHERE application_id <> ''), eff AS (SELECT * FROM ranked WHERE r = 1)"
_CASCADE = f""", cand AS (
  SELECT row_id, 0 AS pri, 'GNA' AS match_source, unnest({O.ids_by_space(O.numeric_ids('gna_raw'))}) AS id, generate_subscripts({O.ids_by_space(O.numeric_ids('gna_raw'))}, 1) AS p FROM applications
  UNION ALL SELECT row_id, 1, 'LTA', unnest({O.ids_by_space(O.numeric_ids_strip('lta_raw'))}), generate_subscripts({O.ids_by_space(O.numeric_ids_strip('lta_raw'))}, 1) FROM applications
  UNION ALL SELECT row_id, 2, '5.2', {O.long_numbers('enh_raw')}[1], 1 FROM applications WHERE enh_raw IS NOT NULL)"""
_LOOKUP = ", lookup AS (SELECT CAST(CASE o_orderkey % 3 WHEN 0 THEN 1200000000 WHEN 1 THEN 412000000 ELSE 2200000000 END + o_orderkey AS VARCHAR) AS application_id, o_totalprice AS amount FROM orders)"


def _lookup(spark, sf):
    base = F.when(c("o_orderkey") % 3 == 0, 1200000000).when(c("o_orderkey") % 3 == 1, 412000000).otherwise(2200000000)
    return A.table(spark, sf, "orders").select((base + c("o_orderkey")).cast("string").alias("application_id"), c("o_totalprice").alias("amount"))


@query("j1_id_cascade_stats", O.views("applications") + _LOOKUP + _CASCADE + """, hit AS (SELECT row_id, match_source, amount, row_number() OVER (PARTITION BY row_id ORDER BY pri, p) AS r FROM cand JOIN lookup ON id = application_id)
SELECT coalesce(match_source, 'none') AS match_source, count(*) AS n_rows, round(sum(coalesce(amount, 0)), 2) AS amount FROM applications LEFT JOIN (SELECT * FROM hit WHERE r = 1) USING (row_id) GROUP BY 1""")
def j1(spark, sf):
    out = J.id_cascade(A.view(spark, sf, "applications"), _lookup(spark, sf), jobs.id_columns())
    return out.groupBy(F.coalesce("match_source", F.lit("none")).alias("match_source")).agg(F.count("*").alias("n_rows"), F.round(F.sum(F.coalesce("amount", F.lit(0.0))), 2).alias("amount"))


@query("j2_two_column_cascade", O.views("applications") + _LOOKUP + _CASCADE + """, hit AS (SELECT row_id, match_source, row_number() OVER (PARTITION BY row_id ORDER BY pri, p) AS r FROM cand JOIN lookup ON id = application_id WHERE pri < 2)
SELECT row_id, match_source FROM applications LEFT JOIN (SELECT * FROM hit WHERE r = 1) USING (row_id)""")
def j2(spark, sf):
    return J.id_cascade(A.view(spark, sf, "applications"), _lookup(spark, sf), jobs.id_columns()[:2]).select("row_id", "match_source")


@query("d3_latest_per_key", O.views("effectiveness") + _EFF + " SELECT application_id, source_file, pos, solar_mw FROM eff")
def d3(spark, sf):
    return jobs.latest_effectiveness(A.view(spark, sf, "effectiveness")).select("application_id", "source_file", "pos", "solar_mw")


@query("d2_key_dedup", O.views("effectiveness") + " SELECT application_id, name_of_applicant, min(source_file) AS source_file FROM effectiveness WHERE application_id || name_of_applicant <> '' GROUP BY 1, 2")
def d2(spark, sf):
    rows = A.view(spark, sf, "effectiveness")
    key, empty = F.concat_ws("||", "application_id", "name_of_applicant"), (c("application_id") == "") & (c("name_of_applicant") == "")
    return R.first_or_unkeyed(rows, key, ["source_file", "pos"], empty).select("application_id", "name_of_applicant", "source_file")


@query("d1_composite_dedup", O.views("applications") + " SELECT source_pdf, page_number, min(row_id) AS row_id FROM applications GROUP BY source_pdf, page_number, trim(coalesce(gna_raw, '')), trim(coalesce(lta_raw, '')), lower(trim(location_raw)), lower(trim(developer_raw))")
def d1(spark, sf):
    rows = A.view(spark, sf, "applications")
    key = R.composite_key([c("gna_raw"), c("lta_raw"), F.lower("location_raw"), F.lower("developer_raw")], rows.columns)
    return R.first_per(rows.withColumn("key", key), ["source_pdf", "page_number", "key"], ["row_id"]).select("source_pdf", "page_number", "row_id")


_STORED = ("psp_mwh", "psp_injection_mw", "psp_drawl_mw", "battery_mwh", "battery_injection_mw", "battery_drawl_mw")


@query("e1_normalise_applications", O.views("applications") + f""" SELECT row_id, {O.developer('developer_raw')} AS developer, {O.numeric_ids('gna_raw')} AS gna_id, {O.numeric_ids_strip('lta_raw')} AS lta_id,
  CASE WHEN enh_raw IS NOT NULL THEN {O.long_numbers('enh_raw')}[1] END AS enhancement_id, {O.mode_bucket('mode_raw')} AS mode, {O.status('status_raw')} AS status, {O.state('location_raw')} AS state,
  {O.project_type('type_raw')} AS project_type, {O.voltage_text('voltage_raw')} AS voltage_level, {O.date_text('op_date_raw')} AS gna_operational_date,
  trim(substation_raw) AS substation, nullif(quantum_raw, 'NA') AS applied_quantum_mw, nullif(granted_raw, '-') AS granted_quantum_mw, submitted_raw AS submission_date, start_raw AS start_date, replace(added_raw, 'from ', '') AS added_date,
  CASE row_id % 11 WHEN 0 THEN '600' ELSE psp_mwh_raw END AS psp_mwh, CASE row_id % 11 WHEN 0 THEN '100' END AS psp_injection_mw, CASE row_id % 11 WHEN 0 THEN '90' ELSE psp_drawl_raw END AS psp_drawl_mw,
  nullif(battery_mwh_raw, 'NA') AS battery_mwh, battery_injection_raw AS battery_injection_mw, battery_drawl_raw AS battery_drawl_mw
FROM applications WHERE coalesce(gna_raw, lta_raw, enh_raw) IS NOT NULL AND NOT contains(lower(nature_raw), 'bulk consumer')""")
def e1(spark, sf):
    return jobs.normalise(A.view(spark, sf, "applications"), F.lit("1995-06-15").cast("date")).select("row_id", "developer", "gna_id", "lta_id", "enhancement_id", "mode", "status", "state", "project_type", "voltage_level", "gna_operational_date", "substation", "applied_quantum_mw", "granted_quantum_mw", "submission_date", "start_date", "added_date", *_STORED)


_MATCH = O.views("applications", "effectiveness") + _EFF + _CASCADE + ", hit AS (SELECT row_id, match_source, eff.*, row_number() OVER (PARTITION BY row_id ORDER BY pri, p) AS k FROM cand JOIN eff ON id = application_id), m AS (SELECT a.*, h.* EXCLUDE (row_id) FROM applications a LEFT JOIN (SELECT * FROM hit WHERE k = 1) h ON a.row_id = h.row_id)"


def _matched(spark, sf):
    return jobs.match_effectiveness(A.view(spark, sf, "applications"), A.view(spark, sf, "effectiveness"))


@query("e2_a14_merge_effectiveness", _MATCH + """ SELECT row_id, match_source, CASE WHEN name_of_applicant IS NOT NULL THEN name_of_applicant ELSE developer_raw END AS developer, solar_mw, wind_mw, ess_mw,
  hydro_mw, CASE WHEN contains(lower(type_of_project), 'hybrid') THEN solar_mw + wind_mw + coalesce(ess_mw, 0) + coalesce(hydro_mw, 0) END AS hybrid_mw, CASE WHEN substation LIKE 'PS%' THEN substation ELSE substation_raw END AS substation,
  """ + f"CASE WHEN m.state = 'Gujarat' THEN m.state ELSE {O.state('location_raw')} END AS state, coalesce(installed_capacity_raw, quantum_raw) AS quantum, region, type_of_project FROM m")
def e2(spark, sf):
    return jobs.merge_effectiveness(_matched(spark, sf)).select("row_id", "match_source", "developer", "solar_mw", "wind_mw", "ess_mw", "hydro_mw", "hybrid_mw", c("merged_substation").alias("substation"), c("merged_state").alias("state"), "quantum", c("merged_region").alias("region"), c("merged_type").alias("type_of_project"))


@query("e3_operational_date", _MATCH + f""" SELECT row_id, strftime(greatest({O.parse_date('op_date_raw')}, CASE WHEN match_source IN ('GNA', 'LTA') THEN {O.parse_date('expected_date_raw')} END), '%d.%m.%Y') AS op_date,
  CASE WHEN greatest({O.parse_date('op_date_raw')}, CASE WHEN match_source IN ('GNA', 'LTA') THEN {O.parse_date('expected_date_raw')} END) > DATE '1995-06-15' THEN 'Yes'
       WHEN greatest({O.parse_date('op_date_raw')}, CASE WHEN match_source IN ('GNA', 'LTA') THEN {O.parse_date('expected_date_raw')} END) IS NOT NULL THEN 'No' END AS op_flag FROM m""")
def e3(spark, sf):
    return jobs.operational_date(_matched(spark, sf), F.lit("1995-06-15").cast("date")).select("row_id", "op_date", "op_flag")


@query("e4_additional_date", _MATCH + f" SELECT row_id, strftime(greatest({O.parse_date('op_date_raw')}, {O.parse_date('expected_date_raw')}), '%d.%m.%Y') AS added_date FROM m")
def e4(spark, sf):
    return jobs.additional_date(_matched(spark, sf)).select("row_id", "added_date")


@query("e5_breakup_capacity", _MATCH + """, x AS (SELECT row_id, application_id, type_of_project, coalesce(solar_mw, 0) AS s, coalesce(wind_mw, 0) AS w, coalesce(ess_mw, 0) + coalesce(hydro_mw, 0) AS e, coalesce(hydro_mw, 0) AS h, row_id % 5 AS t FROM m WHERE application_id IS NOT NULL)
SELECT row_id, nullif(s + CASE t WHEN 0 THEN 300.0 ELSE 0 END, 0) AS solar, nullif(w + CASE t WHEN 2 THEN 12.0 ELSE 0 END, 0) AS wind,
  nullif(CASE WHEN type_of_project IN ('Hybrid', 'Solar + ESS') THEN s + w + e + CASE t WHEN 0 THEN 300.0 WHEN 1 THEN 500.0 WHEN 2 THEN 31.0 ELSE 0 END WHEN t = 1 THEN s + w + e + 500.0 ELSE 0 END, 0) AS hybrid, nullif(h, 0) AS hydro FROM x""")
def e5(spark, sf):
    return jobs.breakup_capacity(_matched(spark, sf)).filter("application_id is not null").select("row_id", "solar", "wind", "hybrid", "hydro")


@query("a3_match_statistics", _MATCH + " SELECT coalesce(match_source, 'unmatched') AS match_source, count(*) AS n_rows FROM m GROUP BY 1")
def a3(spark, sf):
    return jobs.match_statistics(_matched(spark, sf))


@query("a3_a15_job_statistics", _MATCH + f""", d AS (SELECT *, {O.parse_date('op_date_raw')} AS base, {O.parse_date('expected_date_raw')} AS theirs FROM m)
SELECT count(*) FILTER (match_source = 'GNA') AS matched_gna, count(*) FILTER (match_source = 'LTA') AS matched_lta, count(*) FILTER (match_source = '5.2') AS matched_52, count(*) FILTER (match_source IS NULL) AS unmatched, count(*) AS total_rows,
  count(*) FILTER (match_source IS NOT NULL AND theirs IS NOT NULL AND (base IS NULL OR theirs > base)) AS dates_updated, count(*) FILTER (match_source IS NOT NULL AND base IS NOT NULL AND (theirs IS NULL OR theirs <= base)) AS dates_kept,
  count(*) FILTER (match_source IS NOT NULL AND base IS NULL AND theirs IS NULL) AS no_date, count(*) FILTER (match_source IS NOT NULL AND solar_mw + wind_mw > 0) AS computed, count(*) FILTER (match_source IS NULL) AS skipped FROM d""")
def a3_job(spark, sf):
    return jobs.job_statistics(jobs.mapping(A.view(spark, sf, "applications"), A.view(spark, sf, "effectiveness"), F.lit("1995-06-15").cast("date")))


@query("e12_mapping_job", _MATCH + f""" SELECT row_id, match_source, CASE WHEN name_of_applicant IS NOT NULL THEN name_of_applicant ELSE developer_raw END AS developer, solar_mw,
  strftime(greatest({O.parse_date('op_date_raw')}, CASE WHEN match_source IN ('GNA', 'LTA') THEN {O.parse_date('expected_date_raw')} END), '%d.%m.%Y') AS op_date,
  strftime(greatest({O.parse_date('op_date_raw')}, {O.parse_date('expected_date_raw')}), '%d.%m.%Y') AS added_date FROM m""")
def e12(spark, sf):
    out = jobs.mapping(A.view(spark, sf, "applications"), A.view(spark, sf, "effectiveness"), F.lit("1995-06-15").cast("date"))
    return out.select("row_id", "match_source", "developer", "solar_mw", "op_date", "added_date")


_J3 = O.views("applications", "coordination") + """, need AS (SELECT row_id, 0 AS pri, p, x AS needle, 'GNA' AS match_source FROM (SELECT row_id, unnest([cast(1200000000 + row_id as varchar), cast(1100000000 + row_id as varchar)]) AS x, unnest([0, 1]) AS p FROM applications WHERE gna_raw IS NOT NULL)
  UNION ALL SELECT row_id, 2, 0, CAST(2200000000 + row_id AS VARCHAR), '5.2' FROM applications WHERE enh_raw IS NOT NULL UNION ALL SELECT row_id, 1, 0, CAST(412000000 + row_id AS VARCHAR), 'LTA' FROM applications WHERE lta_raw IS NOT NULL),
hay AS (SELECT row_idx, regexp_replace(lower(connectivity_applicant), '[^a-z0-9/-]', '', 'g') AS id FROM coordination), hit AS (SELECT row_id, match_source, row_idx, row_number() OVER (PARTITION BY row_id ORDER BY pri, p, row_idx) AS k FROM need JOIN hay ON contains(id, needle))"""


def _j3(spark, sf, blocked):
    apps = A.view(spark, sf, "applications")
    ids = [(n, T.ids_by_space(e)) for n, e in (("GNA", T.numeric_ids(c("gna_raw"))), ("LTA", T.numeric_ids(c("lta_raw"), True)), ("5.2", T.enhancement_id(c("enh_raw"), c("gna_raw"), c("lta_raw"), c("mode_raw"))))]
    return J.ids_in_text(apps, A.view(spark, sf, "coordination"), ids, "row_id", "connectivity_applicant", "row_idx", blocked)


query("j3_id_in_text_join", _J3 + " SELECT row_id, match_source, row_idx FROM hit WHERE k = 1")(lambda spark, sf: _j3(spark, sf, True))


@query("e7_w1_coordination_mapping", _J3 + f" SELECT row_id, match_source, CASE WHEN {O.is_effective('status_text')} THEN {O.mw_total('schedule_text')} END AS gna, CASE WHEN NOT {O.is_effective('status_text')} THEN {O.mw_total('schedule_text', True)} END AS tgna, regexp_extract(scope_text, 'Bay no. (\\d+)', 1) AS bay_no FROM hit JOIN coordination USING (row_idx) WHERE k = 1")
def e7(spark, sf):
    return jobs.map_coordination(_j3(spark, sf, True), A.view(spark, sf, "coordination")).select("row_id", "match_source", "gna", "tgna", "bay_no")


# an identifier counts wherever it is in a normalised value, so it meets all parts of values that are as long as some identifier
@query("a10_d6_id_hits", O.views("coordination", "effectiveness") + f""", n AS (SELECT DISTINCT application_id, {O.normalize_id('application_id')} AS needle FROM effectiveness WHERE application_id <> ''), l AS (SELECT DISTINCT length(needle) AS l FROM n WHERE length(needle) >= 3),
h AS (SELECT row_idx, {O.normalize_id('connectivity_applicant')} AS hay FROM coordination UNION SELECT row_idx, {O.normalize_id('pooling_station')} FROM coordination), i AS (SELECT row_idx, hay, l, unnest(range(1, length(hay) - l + 2)) AS i FROM h JOIN l ON length(hay) >= l), p AS (SELECT DISTINCT row_idx, substr(hay, i, l) AS needle FROM i)
SELECT application_id, row_idx, CAST(count(*) AS INT) AS id_hits FROM n JOIN p USING (needle) GROUP BY application_id, row_idx""")
def a10(spark, sf):
    left = A.view(spark, sf, "effectiveness").filter("application_id <> ''").select(c("application_id").alias("left_id")).distinct().withColumn("ids", F.array("left_id"))
    return J.id_hits(left, A.view(spark, sf, "coordination"), ["connectivity_applicant", "pooling_station"]).select(c("left_id").alias("application_id"), "row_idx", c("id_hits").cast("int").alias("id_hits"))


@query("j4_j5_e8_best_match")
def j4(spark, sf):
    """Applications by supplier name against all coordination rows; tested against plain Python."""
    return jobs.coordination_layer(A.view(spark, sf, "effectiveness"), A.view(spark, sf, "coordination"))


@query("c30_c31_c32_scores", O.views("coordination") + f""", n AS (SELECT row_idx, length({O.squeeze('connectivity_applicant')}) AS a, length({O.squeeze('pooling_station')}) AS p, connectivity_applicant, status_text FROM coordination)
SELECT row_idx, 1.0 AS same, 2.0 * a / (2 * a + 3) AS longer, 2.0 * (a - 4) / (2 * a - 4) AS shorter, contains(lower(connectivity_applicant), 'supplier') AS inside,
  0.5 * least(1.0, 2.0 * a / (2 * a + 3) + 0.15) + 0.5 * CASE WHEN row_idx % 2 = 0 THEN 1.0 ELSE 0.0 END AS score FROM n""")
def c30(spark, sf):
    """Texts against themselves with a part more or less, where the ratio has a closed form."""
    rows = A.view(spark, sf, "coordination")
    n, p = T.normalize(c("connectivity_applicant")), T.normalize(c("pooling_station"))
    more, other = F.concat(n, F.lit("|~^")), F.when(c("row_idx") % 2 == 0, p).otherwise("")
    rows = rows.withColumns({"n": n, "more": more, "less": F.expr("right(lower(trim(connectivity_applicant)), length(connectivity_applicant) - 4)"), "p": p, "other": other})
    score = J.combined(J.similarity("n", "more"), J.similarity("other", "p"), F.lit(True), c("other") != "")
    return rows.select("row_idx", J.similarity("n", "n").alias("same"), J.similarity("n", "more").alias("longer"), J.similarity("n", "less").alias("shorter"), T.contains_either(F.lit("Supplier"), c("connectivity_applicant")).alias("inside"), score.alias("score"))


from recordweave import queries_more  # noqa: E402,F401  registers the rest
