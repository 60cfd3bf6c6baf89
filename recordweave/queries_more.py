"""Registered queries: bay tables, ledger, listings, answers, reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordweave import oracle as O
from recordweave.functions import names as N
from recordweave.functions import text as T
from recordweave.operators import joins as J
from recordweave.operators import ordering as R
from recordweave.plans import bays as B
from recordweave.plans import headers as H
from recordweave.plans import jobs
from recordweave.queries import columns, query
from recordweave.sources import adapters as A
from recordweave.sources import files as S
from recordweave.sources import ledger as L
from recordweave.streaming import incremental

c = F.col
_SECTION = "regexp_matches(bay_no_220kv, '(?i)^section[\\s\\-]*[a-z]')"
_FILLED = f"len(list_filter([{', '.join(B.CELLS)}], lambda x: x <> ''))"
_DATA = f"((CASE WHEN {_SECTION} THEN '' ELSE bay_no_220kv END) <> '' OR {' OR '.join(f"{x} <> ''" for x in B.BY_VOLTAGE if x != 'bay_no_220kv')})"
_HELD = ", ".join(f"first_value(nullif({x}, '') IGNORE NULLS) OVER w AS {x}" for x in B.HEADER)
_SIDE = "SELECT source_pdf, page_number, row_idx, group_no, section, name_of_substation, substation_coordinates, region, sl_no, '{v}kv' AS voltage_key, {bay} AS bay_no, quantum_{v}kv AS connectivity_quantum_mw, name_of_entity_{v}kv AS entity_name, margin_bay_no_{v}kv AS margin_bay_no, margin_{v}kv AS margin_available_mw, space_provision_{v}kv AS space_provision, remarks FROM p WHERE {data}"
_PARSED = O.views("bay_cells") + f""", g AS (SELECT *, last_value(CASE WHEN {_SECTION} THEN bay_no_220kv END IGNORE NULLS) OVER w AS section,
  sum(CASE WHEN regexp_matches(sl_no, '^\\d+(?:\\.\\d+)?$') OR (name_of_substation <> '' AND substation_coordinates <> '') THEN 1 ELSE 0 END) OVER w AS group_no FROM bay_cells WINDOW w AS (PARTITION BY source_pdf, page_number ORDER BY row_idx ROWS UNBOUNDED PRECEDING)),
p AS (SELECT * EXCLUDE ({', '.join(B.HEADER)}), {_HELD} FROM g WINDOW w AS (PARTITION BY source_pdf, page_number, group_no ORDER BY row_idx ROWS UNBOUNDED PRECEDING)),
e AS ({_SIDE.format(v='220', bay=f"CASE WHEN {_SECTION} THEN '' ELSE bay_no_220kv END", data=_DATA)} UNION ALL {_SIDE.format(v='400', bay='bay_no_400kv', data=_DATA)}),
x AS (SELECT * FROM e WHERE bay_no <> ''),
l AS (SELECT source_pdf, page_number, group_no, voltage_key, bay_no, arg_max(entity_name, row_idx) AS entity_name, min(row_idx) AS pos, min(name_of_substation) AS name_of_substation, min(substation_coordinates) AS substation_coordinates FROM x WHERE bay_no <> '' GROUP BY ALL HAVING arg_max(entity_name, row_idx) <> '')"""

columns("f10_f11_f12_f13_row_kinds", "bay_cells", "row_idx", {
    "section": (lambda: B.is_section(B.cells()), f"{_FILLED} = 1 AND {_SECTION}"), "total_row": (lambda: B.is_total(B.cells()), f"{_FILLED} = 1 AND coalesce(try_cast(coalesce({', '.join(f"nullif({x}, '')" for x in B.CELLS)}) AS DOUBLE) IS NOT NULL, false)"),
    "sub_header": (lambda: B.is_sub_header(B.cells()), "false"), "has_data": (lambda: B.has_data(), _DATA),
})
columns("p6_f9_named_cells", "bay_cells", "row_idx", {
    "first_cell": (lambda: B.named(B.cells(), ["a", "b"])[0], "sl_no"), "fifth": (lambda: B.named(B.cells(), list("abcdefgh"))[4], "capacity_planned_mva"), "beyond": (lambda: B.named(B.cells(), list("abcdefghijklmnopqrstu"))[20], "''"), "header": (lambda: B.is_inline_header(B.cells()), "false"),
})


@query("s2_f7_target_tables", O.views("bay_cells") + " SELECT source_pdf, page_number, min(row_idx) AS first_row FROM bay_cells WHERE name_of_substation <> '' GROUP BY 1, 2")
def f7(spark, sf):
    rows = A.view(spark, sf, "bay_cells").withColumn("header", F.concat_ws(" ", F.when(c("name_of_substation") != "", F.lit("Sl No Name of Substation Bay No"))))
    return rows.filter(B.is_target_table(c("header"))).groupBy(*B.PAGE).agg(F.min("row_idx").alias("first_row"))


@query("f8_drop_leading_rows", O.views("bay_cells") + ", r AS (SELECT *, sum(CASE WHEN sl_no = '' THEN 0 ELSE 1 END) OVER (PARTITION BY source_pdf, page_number ORDER BY row_idx) AS body FROM bay_cells) SELECT page_number, row_idx FROM r WHERE body > 0")
def f8(spark, sf):
    return R.drop_leading(A.view(spark, sf, "bay_cells"), c("sl_no") == "", B.PAGE, B.ORDER).select("page_number", "row_idx")


@query("w2_w3_w4_p10_inherited_headers", _PARSED + " SELECT row_idx, section, CAST(group_no AS BIGINT) AS group_no, name_of_substation, substation_coordinates FROM p")
def w3(spark, sf):
    return B.parse(A.view(spark, sf, "bay_cells")).select("row_idx", "section", "group_no", c("name_of_substation_filled").alias("name_of_substation"), c("substation_coordinates_filled").alias("substation_coordinates"))


@query("p11_e9_allocation_entries", _PARSED + " SELECT row_idx, voltage_key, bay_no, entity_name, section, name_of_substation, connectivity_quantum_mw, margin_bay_no, margin_available_mw, space_provision, remarks, region, sl_no, bay_no || '/' || entity_name AS searched FROM x")
def p11(spark, sf):
    found = B.entries(B.parse(A.view(spark, sf, "bay_cells")))
    searched = F.concat("search_fields.bay_no", F.lit("/"), "search_fields.entity").alias("searched")
    return found.select("row_idx", "voltage_key", "bay_no", "entity_name", "section", "name_of_substation", "connectivity_quantum_mw", "margin_bay_no", "margin_available_mw", "space_provision", "remarks", "region", "sl_no", searched)


@query("p10_bay_records", _PARSED + f" SELECT row_idx, section, {', '.join(f'coalesce({x}, {chr(39) * 2}) AS {x}' for x in B.HEADER)}, {', '.join(B.CELLS[len(B.HEADER):])} FROM p WHERE {_DATA}")
def p10(spark, sf):
    return B.records(B.parse(A.view(spark, sf, "bay_cells"))).drop("source_pdf", "page_number")


def _lookup(spark, sf):
    return B.lookup(B.entries(B.parse(A.view(spark, sf, "bay_cells"))))


@query("w5_p2_p3_bay_lookup", _PARSED + " SELECT page_number, CAST(group_no AS BIGINT) AS group_no, voltage_key, bay_no, entity_name, pos FROM l")
def w5(spark, sf):
    return _lookup(spark, sf).select("page_number", "group_no", "voltage_key", "bay_no", "entity_name", "pos")


@query("p4_bay_text", _PARSED + " SELECT page_number, CAST(group_no AS BIGINT) AS group_no, voltage_key, string_agg(bay_no || ': ' || entity_name, ' | ' ORDER BY pos, bay_no) AS bays FROM l GROUP BY ALL")
def p4(spark, sf):
    return B.bay_text(_lookup(spark, sf)).select("page_number", "group_no", "voltage_key", "bays")


columns("p12_split_entities", "bay_cells", "row_idx", {
    "n": (lambda: F.size(B.entities(c("name_of_entity_220kv"))).cast("long"), "len(list_filter(list_transform(string_split(name_of_entity_220kv, ';'), lambda x: trim(x)), lambda x: x <> ''))"),
    "capacity": (lambda: F.get(B.entities(c("name_of_entity_220kv")), 0)["capacity"], "nullif(regexp_extract(name_of_entity_220kv, '\\(([^)]*\\d[^)]*)\\)', 1), '')"),
    "first_name": (lambda: F.get(B.entities(c("name_of_entity_220kv")), 0)["name"], "nullif(trim(regexp_replace(string_split(name_of_entity_220kv, ';')[1], '\\(.*?\\)', '', 'g')), '')"),
})
_APPS = f", a AS (SELECT row_id, developer_raw AS developer, {O.voltage_key('voltage_raw')} AS voltage_key, CASE WHEN row_id % 7 = 0 THEN CAST(row_id % 50 AS VARCHAR) END AS coordination_bay FROM applications)"
_NAMES = f", n AS (SELECT DISTINCT developer, {O.name_key('developer')} AS k FROM a), ent AS (SELECT l.*, trim(unnest(string_split(entity_name, ';'))) AS entity FROM l), d AS (SELECT DISTINCT entity, {O.name_key('entity')} AS ek, {O.name_key(chr(39) + chr(39) + ' || trim(regexp_replace(entity, ' + chr(39) + '[(].*?[)]' + chr(39) + ', ' + chr(39) + chr(39) + ', ' + chr(39) + 'g' + chr(39) + '))')} AS ck FROM ent WHERE entity <> ''), ok AS (SELECT developer, entity FROM n JOIN d ON contains(k, ek) OR contains(ek, k) OR contains(k, ck) OR contains(ck, k))"
_BAYS = _PARSED.replace(O.views("bay_cells"), O.views("bay_cells", "applications")) + _APPS + _NAMES + ", hits AS (SELECT DISTINCT a.row_id, l.page_number, l.group_no, l.bay_no, l.pos, l.name_of_substation FROM a JOIN ent l USING (voltage_key) JOIN ok ON ok.developer = a.developer AND ok.entity = l.entity WHERE coordination_bay IS NULL)"


def _apps(spark, sf):
    apps = A.view(spark, sf, "applications").select("row_id", c("developer_raw").alias("developer"), T.voltage_key(c("voltage_raw")).alias("voltage_key"), F.when(c("row_id") % 7 == 0, (c("row_id") % 50).cast("string")).alias("coordination_bay"))
    return apps.withColumn("route", B.route(F.lit(None).cast("string"), F.lit(None).cast("string"), c("coordination_bay"), c("voltage_key"), c("developer")))


@query("j6_name_join", _BAYS + " SELECT row_id, page_number, CAST(group_no AS BIGINT) AS group_no, bay_no FROM hits")
def j6(spark, sf):
    hits = J.name_join(_apps(spark, sf).filter("route = 'search'").select("row_id", "developer", "voltage_key"), _lookup(spark, sf))
    return hits.select("row_id", "page_number", "group_no", "bay_no")


@query("j7_routes", O.views("applications") + _APPS + " SELECT row_id, CASE WHEN coordination_bay IS NOT NULL THEN 'coordination' WHEN row_id % 11 = 0 THEN 'has_coordinates' WHEN row_id % 13 = 1 THEN 'has_bay' WHEN voltage_key IS NULL THEN 'no_voltage' WHEN row_id % 17 = 0 THEN 'no_developer' ELSE 'search' END AS route FROM a")
def j7(spark, sf):
    bay = F.when(c("row_id") % 13 == 1, "B12").when(c("row_id") % 13 == 2, "5").otherwise("nan")
    there = F.when(c("row_id") % 11 == 0, "12N 70E").when(c("row_id") % 11 == 1, " ")
    return _apps(spark, sf).select("row_id", B.route(bay, there, c("coordination_bay"), c("voltage_key"), F.when(c("row_id") % 17 != 0, c("developer"))).alias("route"))


@query("e10_d4_a13_bay_mapping", _BAYS + """, one AS (SELECT *, row_number() OVER (PARTITION BY row_id, bay_no ORDER BY page_number, pos, group_no) AS k FROM hits), s AS (SELECT row_id, string_agg(bay_no, ' | ' ORDER BY page_number, pos, bay_no) AS bays FROM one WHERE k = 1 GROUP BY 1)
SELECT a.row_id, coalesce(coordination_bay, bays) AS bay_no, CASE WHEN coordination_bay IS NOT NULL THEN 'coordination' WHEN bays IS NOT NULL THEN 'bay table' END AS bay_source FROM a LEFT JOIN s USING (row_id)""")
def e10(spark, sf):
    return B.map_bays(_apps(spark, sf), _lookup(spark, sf)).select("row_id", "bay_no", "bay_source")


# --- ledger ----------------------------------------------------------------------------------------------------------
_LATEST = O.views("ledger_events") + ", s AS (SELECT *, row_number() OVER (PARTITION BY handler, pdf_name ORDER BY seq DESC) AS r FROM ledger_events), st AS (SELECT * FROM s WHERE r = 1)"


@query("e15_latest_state", _LATEST + " SELECT handler, pdf_name, status, seq FROM st")
def e15(spark, sf):
    return L.latest(A.view(spark, sf, "ledger_events"), ["handler", "pdf_name"], ["seq"]).select("handler", "pdf_name", "status", "seq")


@query("e15_run_lifecycle", O.views("ledger_events") + """, s AS (SELECT handler, pdf_name, arg_max(status, seq) AS last_status, count(*) AS events, count(*) FILTER (status = 'failed') AS failures, min(seq) AS registered_at, max(seq) FILTER (status = 'completed') AS completed_at, max(seq) FILTER (status <> 'failed') AS worked_at FROM ledger_events GROUP BY 1, 2)
SELECT handler, pdf_name, CASE WHEN last_status = 'pending' AND events > 1 THEN 'in_progress' ELSE last_status END AS state, events, failures, registered_at, coalesce(completed_at, -1) AS completed_at, last_status = 'completed' AS is_extracted FROM s""")
def e15_lifecycle(spark, sf):
    return L.lifecycle(A.view(spark, sf, "ledger_events"), ["handler", "pdf_name"], "seq").na.fill(-1, ["completed_at"])


@query("a5_handler_status", _LATEST + ", n AS (SELECT handler, count(*) AS events FROM ledger_events GROUP BY 1) SELECT handler, count(*) AS files, count(*) FILTER (status = 'completed') AS completed, count(*) FILTER (status = 'pending') AS pending, count(*) FILTER (status = 'failed') AS failed, any_value(events) AS events FROM st JOIN n USING (handler) GROUP BY handler")
def a5(spark, sf):
    return L.handler_status(A.view(spark, sf, "ledger_events"))


def _files(spark, sf):
    ev = A.view(spark, sf, "ledger_events").withColumn("pdf_type", F.when(c("seq") % 2 == 0, "Minutes").otherwise("Agenda"))
    files = R.first_per(ev, ["pdf_name"], ["seq"]).select("pdf_name", "pdf_type", "seq")
    return files, ev.filter("status = 'completed'").select("pdf_name").distinct()


_FILES = O.views("ledger_events") + ", f AS (SELECT pdf_name, arg_min(CASE WHEN seq % 2 = 0 THEN 'Minutes' ELSE 'Agenda' END, seq) AS pdf_type, min(seq) AS seq FROM ledger_events GROUP BY 1), done AS (SELECT DISTINCT pdf_name FROM ledger_events WHERE status = 'completed')"


@query("j8_f20_e13_pending", _FILES + " SELECT pdf_name, pdf_type FROM f WHERE pdf_name NOT IN (SELECT pdf_name FROM done) AND pdf_type = 'Minutes'")
def j8(spark, sf):
    return incremental.run_batch(*_files(spark, sf), ["Minutes"]).select("pdf_name", "pdf_type")


@query("j8_pending_of_a_run", _FILES.replace("status = 'completed')", "status = 'completed' AND seq % 5 = 0)") + " SELECT pdf_name, pdf_type FROM f WHERE pdf_name NOT IN (SELECT pdf_name FROM done) AND pdf_type = 'Minutes'")
def j8_some(spark, sf):
    """Pending files where only some of all completions are known."""
    files, _ = _files(spark, sf)
    known = A.view(spark, sf, "ledger_events").filter("status = 'completed' and seq % 5 = 0").select("pdf_name").distinct()
    return incremental.run_batch(files, known, ["Minutes"]).select("pdf_name", "pdf_type")


@query("j9_completed", _FILES + " SELECT pdf_name, pdf_type FROM f WHERE pdf_name IN (SELECT pdf_name FROM done)")
def j9(spark, sf):
    return J.completed(*_files(spark, sf), "pdf_name").select("pdf_name", "pdf_type")


@query("j10_new_files", O.views("ledger_events") + " SELECT pdf_name FROM ledger_events EXCEPT SELECT pdf_name FROM ledger_events WHERE seq < 500")
def j10(spark, sf):
    ev = A.view(spark, sf, "ledger_events").select("pdf_name", "seq")
    return ev.select("pdf_name").distinct().join(ev.filter("seq < 500"), "pdf_name", "left_anti")


@query("j14_d10_insert_or_ignore", O.views("ledger_events") + " SELECT pdf_name, min(seq) FILTER (seq % 3 = 0) AS seq FROM ledger_events GROUP BY 1 HAVING seq IS NOT NULL UNION ALL SELECT pdf_name, min(seq) FROM ledger_events GROUP BY 1 HAVING count(*) FILTER (seq % 3 = 0) = 0")
def j14(spark, sf):
    ev = A.view(spark, sf, "ledger_events").select("pdf_name", "seq")
    held = R.first_per(ev.filter("seq % 3 = 0"), ["pdf_name"], ["seq"])
    return J.insert_or_ignore(held, ev.filter("seq % 3 <> 0"), ["pdf_name"], ["seq"])


@query("d8_upsert_records", O.views("ledger_events") + ", k AS (SELECT *, 'UNKNOWN::NO_LTA::' || handler || '::' || pdf_name AS record_key FROM ledger_events) SELECT record_key, max(seq) AS seq FROM k GROUP BY 1")
def d8(spark, sf):
    ev = A.view(spark, sf, "ledger_events")
    none = F.lit(None).cast("string")
    return L.latest(ev.withColumn("record_key", L.record_key(none, none, c("handler"), c("pdf_name"))), ["record_key"], ["seq"]).select("record_key", "seq")


@query("d9_exports", O.views("ledger_events") + " SELECT handler, pdf_name, CASE WHEN count(*) > 1 THEN 'regenerated' ELSE 'generated' END AS state FROM ledger_events GROUP BY 1, 2")
def d9(spark, sf):
    return L.exports(A.view(spark, sf, "ledger_events"), ["handler", "pdf_name"], ["seq"]).select("handler", "pdf_name", "state")


@query("d11_d7_union_migration", O.views("ledger_events") + " SELECT DISTINCT handler, pdf_name FROM ledger_events")
def d11(spark, sf):
    ev = A.view(spark, sf, "ledger_events").select("handler", "pdf_name", "seq")
    return ev.filter("seq % 2 = 0").unionByName(ev.filter("seq % 2 = 1")).dropDuplicates(["handler", "pdf_name"]).drop("seq")


@query("a4_a15_table_counts", O.views("applications", "ledger_events") + " SELECT 'applications' AS table_name, count(*) AS n_rows FROM applications UNION ALL SELECT 'events', count(*) FROM ledger_events")
def a4(spark, sf):
    return L.table_counts({"applications": A.view(spark, sf, "applications"), "events": A.view(spark, sf, "ledger_events")})


@query("s11_record_export", O.views("ledger_events") + " SELECT seq, json_extract_string(data_json, '$.k') AS k, len(json_keys(data_json)) AS n_keys FROM ledger_events WHERE handler = 'cmets'")
def s11(spark, sf):
    return L.export_rows(A.view(spark, sf, "ledger_events"), "cmets").select("seq", F.try_element_at("data", F.lit("k")).alias("k"), F.size(F.map_keys("data")).cast("long").alias("n_keys"))


@query("a1_a2_run_counters", O.views("page_text") + " SELECT count(DISTINCT source_pdf) AS documents, count(*) AS pages, CAST(sum(length(text)) AS BIGINT) AS chars FROM page_text")
def a1(spark, sf):
    return A.view(spark, sf, "page_text").agg(F.count_distinct("source_pdf").alias("documents"), F.count("*").alias("pages"), F.sum(F.length("text")).alias("chars"))


# --- listings --------------------------------------------------------------------------------------------------------
_LINKS = """WITH t AS (SELECT page_id, url, unnest(regexp_extract_all(html, '(?is)<a\\s[^>]*href="[^"]*"[^>]*>.*?</a>')) AS a, generate_subscripts(regexp_extract_all(html, '(?is)<a\\s[^>]*href="[^"]*"[^>]*>.*?</a>'), 1) - 1 AS pos FROM pages),
k AS (SELECT page_id, url, CAST(pos AS INT) AS pos, regexp_extract(a, '(?i)href="([^"]*)"', 1) AS href, trim(regexp_replace(regexp_replace(a, '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g')) AS label FROM t)"""


_SECTIONS = """WITH t AS (SELECT page_id, regexp_extract_all(html, '(?is)<h[1-6][^>]*>.*?</h[1-6]>|<a\\s[^>]*href="[^"]*"[^>]*>.*?</a>') AS found FROM pages),
x AS (SELECT page_id, unnest(found) AS m, generate_subscripts(found, 1) AS place FROM t),
y AS (SELECT page_id, place, lower(substr(m, 2, 1)) = 'a' AS is_link, regexp_extract(m, '(?i)href="([^"]*)"', 1) AS href, trim(regexp_replace(regexp_replace(m, '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g')) AS label FROM x),
z AS (SELECT *, last_value(CASE WHEN NOT is_link THEN label END IGNORE NULLS) OVER (PARTITION BY page_id ORDER BY place ROWS UNBOUNDED PRECEDING) AS section FROM y),
l AS (SELECT page_id, href, label, section, CAST(row_number() OVER (PARTITION BY page_id ORDER BY place) - 1 AS INT) AS pos FROM z WHERE is_link)"""


def _links(spark, sf):
    return S.links(A.table(spark, sf, "pages"))


@query("s10_c57_link_table", _LINKS + " SELECT page_id, pos, href, label FROM k")
def s10(spark, sf):
    return _links(spark, sf).select("page_id", "pos", "href", "label")


@query("f23_link_filters", _SECTIONS + " SELECT page_id, pos, section FROM l WHERE contains(lower(href), '/t') AND regexp_matches(lower(href), '^[^?#]*[a-z]([?#]|$)') AND contains(lower(label), 'e') AND coalesce(section, '') <> 'Menu'")
def f23(spark, sf):
    links = S.sectioned_links(A.table(spark, sf, "pages"))
    return S.keep_links(links, path="/t", suffix=r"[a-z]", label="e").filter(F.coalesce("section", F.lit("")) != "Menu").select("page_id", "pos", "section")


@query("f22_keyword_in_title", f"SELECT page_id, {O.keyword_in(A.TENDER_TITLE)} AS word, contains(lower({O.dialect(A.TENDER_TITLE)}), 'tender 1') AND NOT contains(lower({O.dialect(A.TENDER_TITLE)}), 'consultant') AS wanted FROM pages")
def f22(spark, sf):
    title = F.expr(A.TENDER_TITLE)
    return A.table(spark, sf, "pages").select("page_id", N.keyword_in(title).alias("word"), N.title_matches(title, "Tender 1").alias("wanted"))


@query("d5_first_url", _LINKS + " SELECT href, min(page_id * 1000 + pos) AS first_at FROM k GROUP BY 1")
def d5(spark, sf):
    return R.first_per(_links(spark, sf), ["href"], ["page_id", "pos"]).select("href", (c("page_id") * 1000 + c("pos")).alias("first_at"))


@query("w6_ordinal_names", _LINKS + " SELECT page_id, pos, lpad(CAST(row_number() OVER (PARTITION BY page_id ORDER BY pos) AS VARCHAR), 2, '0') || '_' || label AS name FROM k")
def w6(spark, sf):
    return _links(spark, sf).select("page_id", "pos", F.concat(R.ordinal(["page_id"], ["pos"]), F.lit("_"), c("label")).alias("name"))


@query("w7_collision_names", _LINKS + ", n AS (SELECT page_id, pos, label || '.pdf' AS name, row_number() OVER (PARTITION BY label ORDER BY page_id, pos) AS r FROM k) SELECT page_id, pos, CASE WHEN r = 1 THEN name ELSE replace(name, '.pdf', '') || '-' || r || '.pdf' END AS name FROM n WHERE NOT contains(replace(name, '.pdf', ''), '.')")
def w7(spark, sf):
    named = _links(spark, sf).withColumn("name", F.concat("label", F.lit(".pdf"))).filter(~c("label").contains("."))
    return named.select("page_id", "pos", R.collision_name("name", ["page_id", "pos"]).alias("name"))


@query("w8_top_n", _LINKS + ", n AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY pos) AS r FROM k) SELECT page_id, pos FROM n WHERE r <= 2")
def w8(spark, sf):
    return R.top_per(_links(spark, sf), ["page_id"], ["pos"], 2).select("page_id", "pos")


@query("w9_global_limit", _LINKS + " SELECT page_id, pos FROM k ORDER BY page_id, pos LIMIT 25")
def w9(spark, sf):
    return R.first_in_all(_links(spark, sf), ["page_id", "pos"], 25).select("page_id", "pos")


@query("w11_f24_one_per_month", O.views("ledger_events") + ", n AS (SELECT *, strftime(ts, '%Y-%m') AS ym, row_number() OVER (PARTITION BY strftime(ts, '%Y-%m'), handler ORDER BY seq) AS r FROM ledger_events) SELECT ym, handler, pdf_name FROM n WHERE r = 1 AND ym >= strftime((SELECT max(ts) FROM ledger_events) - INTERVAL 23 MONTH, '%Y-%m')")
def w11(spark, sf):
    ev = A.view(spark, sf, "ledger_events").withColumn("ym", F.date_format("ts", "yyyy-MM"))
    last = ev.agg(F.date_format(F.add_months(F.max("ts"), -23), "yyyy-MM").alias("since"))
    return R.first_per(ev, ["ym", "handler"], ["seq"]).join(F.broadcast(last), c("ym") >= c("since")).select("ym", "handler", "pdf_name")


columns_pages = [
    ("c44_url_file_name", {"name": (lambda: N.url_file_name(c("url")), "trim(regexp_replace(string_split(regexp_replace(url, '[?#].*$', ''), '/')[-1], '[\\\\/:*?\"<>|]', '_', 'g'), '._')")}),
    ("c58_type_from_path", {"kind": (lambda: N.type_from_path(F.regexp_extract("url", "://[^/]*(/[^?#]*)", 1), "en"), "CASE WHEN string_split(regexp_extract(url, '://[^/]*(/[^?#]*)', 1), '/')[2] = 'en' THEN string_split(regexp_extract(url, '://[^/]*(/[^?#]*)', 1), '/')[3] END")}),
    ("c45_c49_strip_numbers", {"a": (lambda: N.strip_timestamp(F.expr(A.STAMPED_FILE)), f"regexp_replace({O.dialect(A.STAMPED_FILE)}, '^\\d{{9,}}([pP][dD][fF])?[_\\-\\s]*', '')"), "b": (lambda: N.strip_number(F.expr(A.STAMPED_FILE)), f"regexp_replace({O.dialect(A.STAMPED_FILE)}, '^\\d{{6,}}[_\\-\\s]*', '')")}),
    ("c52_ordinal_word", {"word": (lambda: N.ordinal_word(c("page_id")), f"{O.ordinal('page_id')}"), "file": (lambda: N.nct_name(F.expr(A.NCT_FILE)), O.nct_name(A.NCT_FILE))}),
    ("c46_c47_labels", {
        "meeting": (lambda: N.meeting_label(F.expr(A.MEETING_STEM)), O.meeting_label(A.MEETING_STEM)),
        "coordination": (lambda: N.coordination_label(F.expr(A.COORDINATION_STEM), c("page_id") % 2 == 1), O.coordination_label(A.COORDINATION_STEM, "page_id % 2 = 1")),
    }),
    ("c48_c53_dated_names", {"calendar": (lambda: N.calendar_name(F.expr(A.CALENDAR_FILE)), O.calendar_name(A.CALENDAR_FILE)), "bulk": (lambda: N.bulk_name(F.expr(A.BULK_FILE)), O.bulk_name(A.BULK_FILE))}),
    ("c50_c51_c56_titles", {
        "revoked": (lambda: N.revocation_name(F.expr(A.REVOCATION_FILE)), O.revocation_name(A.REVOCATION_FILE)),
        "margin": (lambda: N.margin_name(F.expr(A.MARGIN_FILE)), O.margin_name(A.MARGIN_FILE)),
        "report": (lambda: N.report_category(F.expr(A.REPORT_TITLE), F.expr("concat(cast(page_id as string), '.pdf')")), O.report_category(A.REPORT_TITLE)),
    }),
]
for _name, _made in columns_pages:
    columns(_name, "pages", "page_id", _made)


@query("c43_c54_month_names", O.views("ledger_events") + " SELECT DISTINCT strftime(ts, '%m_%B') AS folder, strftime(ts, '%b-%y') || '_RE effectiveness.pdf' AS shown FROM ledger_events")
def c43(spark, sf):
    from recordweave.functions.numbers import month_folder

    ym = F.date_format("ts", "yyyy-MM")
    return A.view(spark, sf, "ledger_events").select(month_folder(ym).alias("folder"), N.month_display(ym).alias("shown")).distinct()


_LANG = "regexp_extract(url, '://[^/]*/([a-z]+)/', 1)"


def _diff_sides(spark, sf):
    p = A.table(spark, sf, "pages").select(N.url_file_name(c("url")).alias("name"), c("page_id"))
    p = R.first_per(p.filter("name <> ''"), ["name"], ["page_id"])
    return p.filter("page_id % 5 <> 0").select("name", c("page_id").alias("listed_at")), p.filter("page_id % 4 <> 0").select("name", (c("page_id") + (c("page_id") % 3 == 0).cast("int")).alias("held_at"))


@query("j11_j12_e14_listing_diff", "WITH q AS (SELECT trim(regexp_replace(string_split(regexp_replace(url, '[?#].*$', ''), '/')[-1], '[\\\\/:*?\"<>|]', '_', 'g'), '._') AS name, min(page_id) AS page_id FROM pages GROUP BY 1), l AS (SELECT name, page_id AS listed_at FROM q WHERE page_id % 5 <> 0 AND name <> ''), i AS (SELECT name, page_id + CASE WHEN page_id % 3 = 0 THEN 1 ELSE 0 END AS held_at FROM q WHERE page_id % 4 <> 0 AND name <> '') "
       "SELECT name, CASE WHEN listed_at IS NULL THEN 'stale' WHEN held_at IS NULL THEN 'new' WHEN listed_at = held_at THEN 'keep' ELSE 'shift' END AS action FROM l FULL JOIN i USING (name)")  # fmt: skip
def j11(spark, sf):
    return J.listing_diff(*_diff_sides(spark, sf), ["name"], "listed_at", "held_at").select("name", "action")


@query("j13_a8_region_counts", f"WITH d AS (SELECT CASE {_LANG} WHEN 'en' THEN 'NR' WHEN 'de' THEN 'SR' END AS region, page_id % 3 AS kind FROM pages) SELECT region, count(*) FILTER (kind = 0) AS k0, count(*) FILTER (kind = 1) AS k1, count(*) FILTER (kind = 2) AS k2 FROM d WHERE region IS NOT NULL GROUP BY 1")
def j13(spark, sf):
    p = A.table(spark, sf, "pages").select(F.regexp_extract("url", "://[^/]*/([a-z]+)/", 1).alias("region"), (c("page_id") % 3).alias("kind"))
    counts = J.dimension(p, {"en": "NR", "de": "SR"}, "region", keep_unknown=False).groupBy("region").pivot("kind", [0, 1, 2]).count()
    return counts.na.fill(0).select("region", c("0").alias("k0"), c("1").alias("k1"), c("2").alias("k2"))


# --- answers and reports ---------------------------------------------------------------------------------------------
_ANSWERS = "WITH a AS (SELECT 'doc' || conv_id AS source_pdf, CAST(turn AS INT) AS page_number, CAST(conv_id AS VARCHAR) AS gna_raw, role AS type_raw, CAST(length(text) AS VARCHAR) AS applied_quantum_mw, CASE turn % 4 WHEN 1 THEN 2 WHEN 3 THEN 0 ELSE 1 END AS n FROM conversations)"


@query("p14_p1_p5_answer_rows", _ANSWERS + " SELECT source_pdf, page_number, CAST(unnest(range(n)) AS INT) AS row_idx, gna_raw, type_raw, applied_quantum_mw FROM a")
def p14(spark, sf):
    return jobs.answer_rows(A.answers(spark, sf))


@query("u1_p13_p15_registry_rows", O.views("applications") + f" SELECT row_id, {O.numeric_ids('gna_raw')} AS gna_id, {O.status('status_raw')} AS status FROM applications")
def u1(spark, sf):
    reg = jobs.registry(F.lit("1995-06-15").cast("date"))
    return A.view(spark, sf, "applications").select("row_id", *[reg[k].alias(k) for k in ("gna_id", "status")])


@query("s6_d7_report_rows", O.views("applications", "effectiveness") + " SELECT CAST(row_id AS VARCHAR) AS id, developer_raw AS name, NULL::VARCHAR AS kind FROM applications UNION ALL SELECT application_id, name_of_applicant, type_of_project FROM effectiveness")
def s6(spark, sf):
    a = A.view(spark, sf, "applications").select(c("row_id").cast("string").alias("id"), c("developer_raw").alias("name"))
    e = A.view(spark, sf, "effectiveness").select(c("application_id").alias("id"), c("name_of_applicant").alias("name"), c("type_of_project").alias("kind"))
    return S.report([a, e], ["id", "name", "kind"])


@query("f17_f21_p8_usable_records", O.views("effectiveness") + " SELECT pos, coalesce(nullif(trim(application_id), ''), name_of_applicant) AS label FROM effectiveness WHERE (application_id <> '' OR name_of_applicant <> '') AND source_file IN ('eff_1', 'eff_2')")
def f17(spark, sf):
    rows = A.view(spark, sf, "effectiveness").filter(((c("application_id") != "") | (c("name_of_applicant") != "")) & c("source_file").isin("eff_1", "eff_2"))
    return rows.select("pos", F.coalesce(T.none_if_empty(F.trim("application_id")), "name_of_applicant").alias("label"))


@query("p8_resolved_columns", O.views("effectiveness") + " SELECT pos, source_file, application_id AS id, coalesce(nullif(trim(expected_date_raw), ''), nullif(trim(name_of_applicant), ''), '') AS label FROM effectiveness")
def p8(spark, sf):
    rows = A.view(spark, sf, "effectiveness")
    found = J.find_column(rows, "Application No", "APPLICATION_ID")
    return rows.select("pos", "source_file", c(found).alias("id"), J.first_value(rows, "Remarks", "Expected_Date_Raw", "Name_Of_Applicant").alias("label"))


@query("p15_serialised_rows", O.views("applications") + """ SELECT source_pdf, page_number, row_id, json_object('Name of Developers', developer_raw, 'GNA/ST II Application ID', gna_raw, 'Status of application', status_raw, 'meeting_meta', json_object('page', page_number)) AS row_json FROM applications""")
def p15(spark, sf):
    names = {"developer_raw": "Name of Developers", "gna_raw": "GNA/ST II Application ID", "status_raw": "Status of application"}
    rows = A.view(spark, sf, "applications")
    return rows.select("source_pdf", "page_number", "row_id", S.serialised(names, {"page": c("page_number")}).alias("row_json"))


# --- tables read by their headers ------------------------------------------------------------------------------------
_FIELD = "CASE " + " ".join(f"WHEN k = '{h}' THEN '{f}'" for h, f in H.HEADERS.items()) + " " + " ".join(f"WHEN k <> '' AND contains(k, '{h}') THEN '{f}'" for h, f in H.HEADERS.items()) + " END"


@query("p7_header_mapping", O.views("table_rows") + f""", r AS (SELECT *, string_split(cells, '|') AS a FROM table_rows), h AS (SELECT *, contains(lower(cells), 'application') OR contains(lower(cells), 'sl. no') OR contains(lower(cells), 'si no') AS is_header FROM r),
w AS (SELECT *, max(CASE WHEN is_header THEN row_idx END) OVER (PARTITION BY source_pdf ORDER BY row_idx ROWS UNBOUNDED PRECEDING) AS head FROM h),
cell AS (SELECT source_pdf, row_idx, unnest(a) AS cell, generate_subscripts(a, 1) AS i FROM r), m AS (SELECT c.source_pdf, c.row_idx AS head, i, {_FIELD} AS field FROM (SELECT *, trim(regexp_replace(lower(cell), '\\s+', ' ', 'g')) AS k FROM cell) c),
f AS (SELECT w.source_pdf, w.row_idx, m.field, c.cell, row_number() OVER (PARTITION BY w.source_pdf, w.row_idx, m.field ORDER BY c.i DESC) AS r FROM w JOIN m ON m.source_pdf = w.source_pdf AND m.head = w.head JOIN cell c ON c.source_pdf = w.source_pdf AND c.row_idx = w.row_idx AND c.i = m.i WHERE NOT is_header AND m.field IS NOT NULL)
SELECT row_idx, max(cell) FILTER (field = 'application_id') AS application_id, max(cell) FILTER (field = 'name_of_applicant') AS name_of_applicant, max(cell) FILTER (field = 'installed_capacity_mw') AS installed_capacity_mw, max(cell) FILTER (field = 'expected_date') AS expected_date
FROM f WHERE r = 1 GROUP BY row_idx HAVING coalesce(max(cell) FILTER (field = 'application_id'), '') <> '' OR coalesce(max(cell) FILTER (field = 'name_of_applicant'), '') <> ''""")
def p7(spark, sf):
    rows = A.view(spark, sf, "table_rows").withColumn("cells", F.split("cells", r"\|"))
    found = H.records(rows, "cells", ["source_pdf"], ["row_idx"])
    return found.select("row_idx", *[c(x) for x in ("application_id", "name_of_applicant", "installed_capacity_mw", "expected_date")])


from recordweave import queries_plans  # noqa: E402,F401  registers the rest
