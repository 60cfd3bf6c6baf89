"""Registered queries: listings and what to fetch, caches written and read back, streams, global order, voltage of cells."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordweave import oracle as O
from recordweave.functions import numbers as V
from recordweave.functions import text as T
from recordweave.operators import joins as J
from recordweave.operators import ordering as R
from recordweave.plans import bays as B
from recordweave.plans import gates as G
from recordweave.plans import jobs
from recordweave.queries import ORACLE_SQL, query
from recordweave.sources import adapters as A
from recordweave.sources import files as S
from recordweave.sources import ledger as L
from recordweave.sources import listings
from recordweave.sources.staging import new_path, staged
from recordweave.streaming import incremental

c = F.col
ROOT, PATH = "https://listing.example.org", "/uploads/meeting/"


# --- listings --------------------------------------------------------------------------------------------------------
def _held(spark, sf):
    """What an earlier run holds: addresses of agendas with their numbers, and some that are no longer listed."""
    pages = A.table(spark, sf, "pages").select("page_id", F.lit(0).alias("k")).filter("page_id % 4 <> 3")
    url = F.concat(F.when(c("page_id") % 5 == 0, "").otherwise(ROOT), F.expr(A.AGENDA_HREF), F.when(c("page_id") % 11 == 0, "?old").otherwise(""))
    return pages.select(url.alias("url"), (c("page_id") % 50 + 1).alias("held_n"))


_URL = f"CASE WHEN href LIKE 'http%' THEN href ELSE '{ROOT}' || href END"
_LISTED = f"""WITH r AS (SELECT page_id, unnest([0, 1, 2]) AS k FROM pages), x AS (SELECT page_id, k, trim(lower({A.LISTED_REGION})) AS named, {O.dialect(A.NOTICE_HREF)} AS n, {O.dialect(A.AGENDA_HREF)} AS a, {O.dialect(A.MINUTES_HREF)} AS m FROM r),
y AS (SELECT page_id, k, CASE named {' '.join(f"WHEN '{a}' THEN '{b}'" for a, b in listings.REGIONS.items())} END AS region, unnest(['Notice', 'Agenda', 'Minutes']) AS doc_type, unnest([n, a, m]) AS href, unnest([0, 1, 2]) AS spot FROM x),
z AS (SELECT page_id, k, region, doc_type, spot, {_URL} AS url FROM y WHERE region IS NOT NULL AND contains(lower(href), '{PATH}'))"""
_PLAN = _LISTED + f""", f AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY page_id, k, spot) AS first FROM z), g AS (SELECT *, row_number() OVER (PARTITION BY doc_type, region ORDER BY page_id, k, spot) AS n FROM f WHERE first = 1 AND doc_type <> 'Notice'),
q AS (SELECT *, trim(regexp_replace(string_split(regexp_replace(url, '[?#].*$', ''), '/')[-1], '[\\\\/:*?"<>|]', '_', 'g'), '._') AS file FROM g WHERE n <= 200),
p AS (SELECT doc_type, region, n, CASE WHEN n > 99 THEN CAST(n AS VARCHAR) ELSE lpad(CAST(n AS VARCHAR), 2, '0') END || '_' || {O.meeting_label("regexp_replace(file, '\\.[^.]*$', '')")} || lower(coalesce(nullif(regexp_extract(file, '(\\.[^.]*)$', 1), ''), '.pdf')) AS name, url FROM q),
h AS (SELECT CASE WHEN page_id % 5 = 0 THEN '' ELSE '{ROOT}' END || {O.dialect(A.AGENDA_HREF)} || CASE WHEN page_id % 11 = 0 THEN '?old' ELSE '' END AS url, page_id % 50 + 1 AS held_n FROM (SELECT page_id, 0 AS k FROM pages WHERE page_id % 4 <> 3))
SELECT doc_type, region, coalesce(n, -1) AS n, name, url, coalesce(held_n, -1) AS held_n, CASE WHEN n IS NULL THEN 'stale' WHEN held_n IS NULL THEN 'new' WHEN n = held_n THEN 'keep' ELSE 'shift' END AS action FROM p FULL JOIN h USING (url)"""


@query("e14_listed_links", _LISTED + " SELECT page_id, CAST(k AS INT) AS row_no, region, doc_type, url FROM z")
def e14_links(spark, sf):
    return listings.listed(A.view(spark, sf, "listings"), ROOT, PATH).drop("pos")


@query("e14_crawl_plan", _PLAN)
def e14(spark, sf):
    links = listings.listed(A.view(spark, sf, "listings"), ROOT, PATH)
    return listings.crawl_plan(links, _held(spark, sf), most=200).select("doc_type", "region", "n", "name", "url", "held_n", "action").na.fill(-1, ["n", "held_n"])


@query("w13_file_order", "SELECT row_number() OVER (ORDER BY file, page_id) AS n, file, page_id FROM (SELECT page_id, string_split(regexp_replace(url, '[?#].*$', ''), '/')[-1] || '/' || url AS file FROM pages)")
def w13(spark, sf):
    file = F.concat(F.element_at(F.split(F.regexp_replace("url", r"[?#].*$", ""), "/"), -1), F.lit("/"), c("url"))
    return R.global_number(A.table(spark, sf, "pages").select("page_id", file.alias("file")), [], ["file", "page_id"]).select("n", "file", "page_id")


# --- tables of pages -------------------------------------------------------------------------------------------------
@query("s2_f7_first_target_table", O.views("page_tables") + """, t AS (SELECT page_number, table_no, count(*) AS n_rows, lower(coalesce(string_agg(replace(cells, '|', ' '), ' ' ORDER BY row_idx) FILTER (row_idx < 3), '')) AS header FROM page_tables GROUP BY 1, 2),
h AS (SELECT *, regexp_replace(header, '[^a-z0-9]+', '', 'g') AS tight FROM t), k AS (SELECT * FROM h WHERE n_rows >= 2 AND """ + " + ".join(f"CAST(contains(header, '{x}') OR contains(tight, '{x}') AS INT)" for x in B.TARGET_HEADERS) + """ >= 3)
SELECT page_number, CAST(min(table_no) AS INT) AS table_no, arg_min(n_rows, table_no) AS n_rows FROM k GROUP BY 1""")  # fmt: skip
def f7_first(spark, sf):
    rows = A.view(spark, sf, "page_tables").withColumn("cells", F.split("cells", r"\|"))
    return B.first_target_tables(rows, B.PAGE).select("page_number", "table_no", "n_rows")


def _voltage_cells(df):
    """Applications whose cells name voltages in one place or another."""
    n = c("row_id")
    more = lambda x, text, when: F.concat(F.coalesce(c(x), F.lit("")), F.when(when, text).otherwise("")).alias(x)
    return df.select("row_id", F.when(n % 4 == 0, c("voltage_raw")).alias("voltage_raw"), more("substation_raw", " at 400kV", n % 5 == 0), more("location_raw", ", 765 kV and 220 kV", n % 3 == 0), more("developer_raw", " 33 kV", n % 7 == 0), more("mode_raw", " (220kV)", n % 2 == 0), more("nature_raw", " 47 kV", n % 11 == 0), more("type_raw", " 765kv", n % 6 == 1))


_CELLS = """, a AS (SELECT row_id, CASE WHEN row_id % 4 = 0 THEN voltage_raw END AS own, concat_ws(' ', substation_raw || CASE WHEN row_id % 5 = 0 THEN ' at 400kV' ELSE '' END, coalesce(location_raw, '') || CASE WHEN row_id % 3 = 0 THEN ', 765 kV and 220 kV' ELSE '' END, developer_raw || CASE WHEN row_id % 7 = 0 THEN ' 33 kV' ELSE '' END,
  mode_raw || CASE WHEN row_id % 2 = 0 THEN ' (220kV)' ELSE '' END, nature_raw || CASE WHEN row_id % 11 = 0 THEN ' 47 kV' ELSE '' END, type_raw || CASE WHEN row_id % 6 = 1 THEN ' 765kv' ELSE '' END) AS t FROM applications),
l AS (SELECT row_id, nullif(regexp_extract(own, '(?i)\\b(\\d{2,3})\\s*kV\\b', 1), '') AS first, regexp_extract_all(t, '(?i)\\b(\\d{2,3})\\s*kV\\b', 1) AS found FROM a),
v AS (SELECT row_id, unnest(found) AS v, generate_subscripts(found, 1) AS pos FROM l), s AS (SELECT *, v IN ('765', '400', '220', '132', '110', '66', '33') AS standard FROM v), k AS (SELECT row_id, standard, v, count(*) AS n, min(pos) AS pos FROM s GROUP BY ALL),
b AS (SELECT row_id, v, row_number() OVER (PARTITION BY row_id ORDER BY standard DESC, n DESC, pos) AS r FROM k) SELECT l.row_id, coalesce(first, v) || ' kV' AS voltage FROM l LEFT JOIN b ON b.row_id = l.row_id AND r = 1"""


@query("c19_a12_voltage_of_six_cells", O.views("applications") + _CELLS)
def c19_six(spark, sf):
    return _voltage_cells(A.view(spark, sf, "applications")).select("row_id", T.voltage_of_row(c("voltage_raw"), [c(x) for x in T.VOLTAGE_CELLS]).alias("voltage"))


def _gate_sql() -> str:
    """The page gate in SQL: the same patterns, counted and combined. Its engine knows ASCII words only, so other letters are shown as `_`."""
    text = lambda p: "'(?i)" + p.replace("'", "''") + "'"
    held = lambda p: f"regexp_matches(text, {text(p)})"
    count = lambda p: f"len(regexp_extract_all(text, {text(p)}))"
    header = {n: " OR ".join("(" + " AND ".join(map(held, v)) + ")" for v in variants) for n, variants in G.HEADERS.items()}
    value = {n: " + ".join(map(count, p)) + " >= 2" for n, p in G.VALUES.items()}
    names = sorted({*header, *value})
    listed = ", ".join(f"CASE WHEN {' OR '.join(f'({d[n]})' for d in (header, value) if n in d)} THEN '{n}' END" for n in names)
    blocked = " OR ".join([held(p) for p in G.BLOCKED] + [f"{count(p)} >= 2" for p in G.BLOCKED_TWICE])
    shown = "SELECT page_number, regexp_replace(text, '[^\\x00-\\x7F‐–]', '_', 'g') AS text FROM page_text"
    return O.views("page_text") + f", t AS ({shown}), g AS (SELECT page_number, CASE WHEN {blocked} THEN [] ELSE list_filter([{listed}], lambda x: x IS NOT NULL) END AS active FROM t) SELECT page_number, len(active) >= 1 AS passes, array_to_string(active, ',') AS active FROM g"


ORACLE_SQL["f4_page_gate"] = _gate_sql()


# --- caches, one pass of records and statistics, streams -------------------------------------------------------------
@query("e12_s7_records_and_statistics", ORACLE_SQL["a3_a15_job_statistics"].replace("count(*) AS total_rows,", "count(*) AS total_rows, count(*) AS rows_on_disk,"))
def e12_s7(spark, sf):
    """The mapping job writes its records, and the statistics of what it writes; both are read back."""
    job = jobs.mapping(A.view(spark, sf, "applications"), A.view(spark, sf, "effectiveness"), F.lit("1995-06-15").cast("date"))
    folder = new_path(spark, "mapping")
    stats = S.write_observed(job, jobs.job_counters(), folder, ["row_id", "match_source", "developer", "quantum", "op_date", "op_flag", "added_date", "solar", "wind", "hydro", "hybrid"])
    written = spark.read.schema("row_id long").json(f"{folder}/records").agg(F.count("row_id").alias("rows_on_disk"))
    return stats.crossJoin(F.broadcast(written))


@query("s3_s4_cache_round_trip", O.views("applications") + " SELECT source_pdf, count(*) AS n_rows, CAST(sum(page_number) AS BIGINT) AS pages, CASE WHEN CAST(substr(source_pdf, 4) AS INT) % 3 = 0 THEN 2 ELSE 1 END AS run FROM applications GROUP BY source_pdf")
def s3_s4(spark, sf):
    """A cache of one folder a document: half is written, all are added (held ones are skipped), a third are written anew, a broken file is in it."""
    rows = A.view(spark, sf, "applications").select("row_id", "page_number", "source_pdf", F.substring("source_pdf", 4, 9).cast("int").alias("k"))
    folder, plain = new_path(spark, "cache"), lambda df, run: df.drop("k").withColumn("run", F.lit(run))
    S.write_json_cache(plain(rows.filter("k % 2 = 0"), 1), folder)
    S.add_to_cache(plain(rows.withColumn("row_id", F.when(c("k") % 2 == 1, c("row_id"))), 1), folder)
    S.write_json_cache(plain(rows.filter("k % 3 = 0"), 2), folder)
    spark.range(1).select(F.lit('{"row_id": 1, "page').alias("value")).write.text(f"{folder}/source_pdf=broken")
    back = S.read_rows(spark, folder, "row_id long, page_number int, run int, source_pdf string")
    return back.filter("row_id is not null").groupBy("source_pdf").agg(F.count("*").alias("n_rows"), F.sum("page_number").alias("pages"), F.max("run").alias("run"))


@query("e13_stream_records", O.views("ledger_events") + " SELECT handler, pdf_name, 1 AS n FROM ledger_events GROUP BY ALL")
def e13_stream(spark, sf):
    """Files arrive in two lots; each run of the stream takes the new ones, and a key is written once over both."""
    ev = A.view(spark, sf, "ledger_events").select("seq", "handler", "pdf_name")
    base = new_path(spark, "stream")
    for lot in range(2):
        ev.filter(c("seq") % 2 == lot).repartition(4).write.mode("append").json(f"{base}/in")
        incremental.stream_once(spark, f"{base}/in", "seq long, handler string, pdf_name string", f"{base}/sink", f"{base}/state", ["handler", "pdf_name"]).awaitTermination()
    return spark.read.parquet(f"{base}/sink").groupBy("handler", "pdf_name").agg(F.count("*").cast("int").alias("n"))


@query("a15_run_totals", O.views("ledger_events") + """, e AS (SELECT *, CAST(ts AS DATE) AS run, row_number() OVER (PARTITION BY handler, pdf_name ORDER BY seq) AS k FROM ledger_events)
SELECT run, count(*) FILTER (k = 1) AS downloaded, count(DISTINCT handler || '/' || pdf_name) FILTER (status = 'completed') AS extracted, count(DISTINCT handler) FILTER (status = 'completed') AS exports, count(*) AS records FROM e GROUP BY run""")
def a15_totals(spark, sf):
    return L.run_totals(A.view(spark, sf, "ledger_events"), F.to_date("ts"))


# --- rules on varied values ------------------------------------------------------------------------------------------
@query("c42_meeting_dates", "SELECT o_orderkey, strftime(o_orderdate + INTERVAL 120 MONTH, '%d.%m.%Y') AS held FROM orders")
def c42_dates(spark, sf):
    """Dates of meetings in both spelled forms, with and without the ending of the day."""
    d = F.add_months("o_orderdate", 120)
    day = F.concat(F.date_format(d, "d"), F.when(c("o_orderkey") % 3 == 0, "th").otherwise(""))
    text = F.when(c("o_orderkey") % 2 == 0, F.concat(F.lit("held on "), day, F.lit(" "), F.date_format(d, "MMMM yyyy"), F.lit(" in Delhi"))).otherwise(F.concat(F.lit("No. 12 of "), F.date_format(d, "MMMM "), day, F.date_format(d, ", yyyy")))
    return A.table(spark, sf, "orders").select("o_orderkey", V.meeting_date(text).alias("held"))


@query("a11_technology_sums", "SELECT o_orderkey, CAST(o_orderkey % 300 + o_custkey % 7 AS DOUBLE) AS solar, CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderkey % 70 AS DOUBLE) END AS wind, CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_custkey % 50 AS DOUBLE) + 0.5 END AS ess FROM orders")
def a11_sums(spark, sf):
    """MW by technology where names repeat and numbers vary."""
    k, n = c("o_orderkey"), c("o_custkey")
    part = lambda name, value: F.concat(F.lit(name + " ("), value.cast("string"), F.lit(")"))
    text = F.concat_ws(" + ", part("Solar", k % 300), F.when(k % 2 == 0, part("Wind", k % 70)), F.when(k % 3 == 0, part("BESS", n % 50 + F.lit(0.5))), part("solar", n % 7))
    return A.table(spark, sf, "orders").select("o_orderkey", *[V.technology_mw(text)[x].alias(x) for x in ("solar", "wind", "ess")])


_KINDS = [("220 kV", "", ""), ("Bay No.", "Name of Entity", "400kv"), ("400kv", "12", ""), ("", "", ""), ("Sl. No.", "Application ID", "")]


@query("f9_f12_header_kinds", "SELECT p_partkey, p_size % 5 IN (0, 1) AS sub_header, p_size % 5 = 4 AS inline FROM part")
def f9_f12(spark, sf):
    """Sub-headers that leaked into rows, and header rows inside tables."""
    rows = F.array(*[F.array(*map(F.lit, k)) for k in _KINDS])
    return A.table(spark, sf, "part").withColumn("row", F.get(rows, (c("p_size") % 5).cast("int"))).select("p_partkey", B.is_sub_header(c("row")).alias("sub_header"), B.is_inline_header(c("row")).alias("inline"))


_CONTEXT, _KV = "'(?i)voltage|connectivity|sub[\\s-]?station|bus|level'", "'(?i)\\b(\\d{2,3})\\s*kV\\b'"
ORACLE_SQL["c20_voltage_of_page"] = O.views("page_text") + f""", p AS (SELECT page_number, text, string_split_regex(text, {_CONTEXT}) AS pieces, regexp_extract_all(text, {_CONTEXT}) AS words FROM page_text),
m AS (SELECT *, unnest(range(1, len(words) + 1)) AS k FROM p), w AS (SELECT page_number, text, k, length(words[k]) AS n, CAST(list_sum(list_transform(pieces[1:k], lambda x: length(x))) + coalesce(list_sum(list_transform(words[1:k - 1], lambda x: length(x))), 0) AS INT) AS s FROM m),
near AS (SELECT page_number, k, regexp_extract_all(substr(text, greatest(s - 80, 0) + 1, s + n + 80 - greatest(s - 80, 0)), {_KV}, 1) AS v FROM w), hits AS (SELECT page_number FROM near WHERE len(v) > 0 GROUP BY 1),
a AS (SELECT page_number, k, v FROM near UNION ALL SELECT page_number, 0, regexp_extract_all(text, {_KV}, 1) FROM page_text WHERE page_number NOT IN (SELECT page_number FROM hits)),
u AS (SELECT page_number, k, unnest(v) AS v, generate_subscripts(v, 1) AS i FROM a), g AS (SELECT page_number, v, v IN ('765', '400', '220', '132', '110', '66', '33') AS standard, count(*) AS n, min(k * 1000000 + i) AS first FROM u GROUP BY 1, 2),
b AS (SELECT page_number, v, row_number() OVER (PARTITION BY page_number ORDER BY standard DESC, n DESC, first) AS r FROM g) SELECT p.page_number, v || ' kV' AS voltage FROM page_text p LEFT JOIN b ON b.page_number = p.page_number AND r = 1"""


# --- files and functions of the user's -------------------------------------------------------------------------------
@query("s5_discovered_files", "SELECT regexp_extract(url, '://[^/]*/([a-z]+)/', 1) AS folder, CAST(sum(octet_length(encode(url)) + 1) AS BIGINT) AS bytes FROM pages WHERE regexp_matches(url, '://[^/]*/[a-z]+/') GROUP BY 1")
def s5(spark, sf):
    """Files in nested folders, found by their pattern without being read."""
    folder = new_path(spark, "found")
    pages = A.table(spark, sf, "pages").select(F.regexp_extract("url", "://[^/]*/([a-z]+)/", 1).alias("lang"), c("url").alias("value")).filter("lang <> ''")
    pages.withColumn("half", F.length("value") % 2).write.partitionBy("lang", "half").text(folder)
    pages.write.partitionBy("lang").json(f"{folder}/other")
    found = S.discover(spark, folder, "*.txt")
    return found.groupBy(F.regexp_extract("path", "/lang=([a-z]+)/", 1).alias("folder")).agg(F.sum("length").alias("bytes"))


@query("u2_plugged_extractor", O.views("page_text") + " SELECT page_number, unnest(list_distinct(regexp_extract_all(text, '\\b(?:GNA|LTA)\\b'))) AS word FROM page_text WHERE contains(text, 'LTA')")
def u2(spark, sf):
    """Rows that a user's function makes of gated pages: here each keyword of a page once."""

    def words(frames):
        for f in frames:
            found = f.text.str.findall(r"\b(?:GNA|LTA)\b").map(set)
            yield f.assign(word=found)[["page_number", "word"]].explode("word").dropna()

    return jobs.extract(A.view(spark, sf, "page_text").filter(c("text").contains("LTA")).select(c("page_number").cast("long").alias("page_number"), "text"), words, "page_number long, word string")


@query("u4_similarity_in_sql", "SELECT c_custkey, 1.0 AS same, 2.0 * length(c_name) / (2 * length(c_name) + 4) AS longer, 0.0 AS none FROM customer")
def u4(spark, sf):
    """The similarity as a function of SQL text, on pairs whose ratio has a closed form."""
    spark.udf.register("similarity", J.similarity)
    return spark.sql("select c_custkey, similarity(c_name, c_name) as same, similarity(c_name, concat(c_name, '|~^_')) as longer, similarity(c_name, '') as none from {customer}", customer=A.table(spark, sf, "customer"))
