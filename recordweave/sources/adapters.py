"""Domain-shaped views of the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

APPLICATIONS = """
select o_orderkey as row_id, concat('doc', cast(o_orderkey % 50 as string)) as source_pdf, cast(o_orderkey % 7 as int) as page_number,
  case when o_orderkey % 3 = 0 then concat('GNA: ', cast(1200000000 + o_orderkey as string), ', ', cast(1100000000 + o_orderkey as string)) end as gna_raw,
  case when o_orderkey % 2 = 0 then concat('0', cast(412000000 + o_orderkey as string)) end as lta_raw,
  case when o_orderkey % 5 = 0 then concat('Enhancement 5.2 ', cast(2200000000 + o_orderkey as string)) end as enh_raw,
  concat(c_name, case o_orderkey % 4 when 0 then ' Private Limited' when 1 then ' Pvt. Ltd.' when 2 then ' LLP' else '' end) as developer_raw,
  case o_orderkey % 5 when 0 then 'solar (300)' when 1 then 'Hybrid (500)' when 2 then 'Wind (12) + BESS (19)' when 3 then 'Thermal' else 'Generator (Solar)' end as type_raw,
  case o_orderstatus when 'F' then 'Granted' when 'O' then 'Revoked by authority' else '--' end as status_raw,
  case when o_orderpriority like '1%' then 'SECI LOA' when o_orderpriority like '2%' then 'Land Route' else 'n/a' end as mode_raw,
  case o_orderkey % 3 when 0 then 'Site at 220kV' when 1 then 'Bus 400 KV' else '765' end as voltage_raw,
  concat('village ', cast(o_custkey as string), case o_orderkey % 3 when 0 then ', Rajasthan' when 1 then ', Andhra Pradesh.' else ', Atlantis' end) as location_raw,
  case o_orderkey % 6 when 5 then 'Bulk consumer' else 'Generator' end as nature_raw,
  case when o_orderkey % 4 <> 3 then concat('SCoD ', date_format(o_orderdate, 'dd.MM.yyyy')) end as op_date_raw,
  concat(' SS-', cast(o_custkey % 100 as string)) as substation_raw, case o_orderkey % 4 when 0 then 'NA' else cast(o_orderkey % 500 as string) end as quantum_raw,
  case o_orderkey % 7 when 0 then '-' else concat(cast(o_orderkey % 300 as string), ' MW') end as granted_raw, date_format(o_orderdate, 'dd-MM-yyyy') as submitted_raw,
  case when o_orderkey % 3 = 1 then date_format(o_orderdate, 'yyyy/MM/dd') end as start_raw, case when o_orderkey % 5 = 1 then concat('from ', date_format(o_orderdate, 'dd.MM.yyyy')) end as added_raw,
  case o_orderkey % 11 when 0 then 'Pump Storage for 600 MWh' when 1 then '400 MWh' end as psp_mwh_raw, case when o_orderkey % 11 = 0 then 'max injection: 100' end as psp_injection_raw, case when o_orderkey % 11 < 2 then 'drawl 90' end as psp_drawl_raw,
  case o_orderkey % 13 when 0 then '200 MWh' when 1 then 'NA' end as battery_mwh_raw, case when o_orderkey % 13 = 0 then 'BESS injection 50' end as battery_injection_raw, case when o_orderkey % 13 = 2 then '40' end as battery_drawl_raw
from {orders} join {customer} on o_custkey = c_custkey
"""
EFFECTIVENESS = """
select concat('eff_', cast(l_linenumber as string)) as source_file, l_partkey as pos,
  case when l_orderkey % 9 = 0 then '' else cast(1200000000 + l_orderkey as string) end as application_id,
  concat('Applicant ', cast(l_suppkey as string)) as name_of_applicant,
  case l_suppkey % 4 when 0 then 'Solar' when 1 then 'Wind' when 2 then 'Hybrid' else 'Solar + ESS' end as type_of_project,
  concat('1,', cast(100 + cast(l_quantity as int) as string)) as installed_capacity_raw,
  l_quantity as solar_mw, l_quantity * 2 as wind_mw, case when l_returnflag = 'R' then cast(5.0 as double) end as ess_mw,
  case when l_returnflag = 'A' then date_format(l_shipdate, 'dd-MM-yyyy') when l_returnflag = 'R' then date_format(l_shipdate, 'yyyy/MM/dd') else 'N/A' end as expected_date_raw,
  case l_suppkey % 3 when 0 then concat('PS-', cast(l_partkey % 50 as string)) when 1 then 'N/A' end as substation, case l_suppkey % 3 when 1 then 'Gujarat' else '-' end as state, case l_suppkey % 2 when 0 then 'NR' end as region,
  case when l_returnflag = 'N' then cast(7.0 as double) end as hydro_mw, l_suppkey as tie1, l_extendedprice as tie2
from {lineitem}
"""
COORDINATION = """
select l_orderkey as row_idx, concat('Supplier#', cast(min(l_suppkey) as string), ' (', cast(1200000000 + l_orderkey as string), ')') as connectivity_applicant,
  concat('PS-', cast(min(l_partkey) as string)) as pooling_station,
  array_join(transform(array_sort(collect_list(struct(l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice, l_quantity, l_returnflag))), r -> concat(cast(cast(r.l_quantity as int) as string), ' MW: ', date_format(r.l_shipdate, 'dd.MM.yyyy'), case when r.l_returnflag = 'R' then ' (Commissioned)' else '' end)), '; ') as schedule_text,
  case l_orderkey % 3 when 0 then 'Effective' when 1 then 'Not effective' else 'Likely to be operationalized' end as status_text,
  case when l_orderkey % 4 = 0 then concat('Bay no. ', cast(min(l_suppkey) + 1 as string), ' & 220') else 'line' end as scope_text
from {lineitem} group by l_orderkey
"""
BAY_CELLS = """
select 'bays' as source_pdf, cast(p_partkey % 20 as int) as page_number, p_partkey as row_idx,
  case when p_partkey % 100 < 20 then cast(p_partkey % 97 as string) else '' end as sl_no,
  case when p_partkey % 100 < 20 then concat('SS-', cast(p_partkey as string)) else '' end as name_of_substation,
  case when p_partkey % 100 < 20 and p_size % 2 = 0 then concat(cast(p_size as string), 'N') else '' end as substation_coordinates,
  case when p_partkey % 31 = 0 then 'Section-A' when p_size % 3 = 0 then '' else cast(p_partkey % 17 as string) end as bay_no_220kv,
  case when p_size % 5 = 0 then '' else concat('Customer#', lpad(cast(p_partkey % 1500 as string), 9, '0'), ' Ltd. (50.6); ', p_brand) end as name_of_entity_220kv,
  case when p_size % 4 = 0 then cast(p_partkey % 13 as string) else '' end as bay_no_400kv, case when p_size % 7 = 0 then '' else p_brand end as name_of_entity_400kv,
  case when p_partkey % 100 < 20 and p_size % 3 < 2 then concat('R', cast(p_size % 3 as string)) else '' end as region, case when p_partkey % 50 < 10 and p_size % 4 = 1 then '500' else '' end as capacity_planned_mva,
  case when p_partkey % 50 < 10 then cast(p_size as string) else '' end as capacity_existing_mva, case when p_partkey % 100 = 3 then '315' else '' end as capacity_under_implementation_mva,
  case when p_size % 5 = 1 then cast(p_size * 10 as string) else '' end as quantum_220kv, case when p_size % 8 = 0 then cast(p_size + 1 as string) else '' end as quantum_400kv,
  case when p_size % 10 = 3 then cast(p_partkey % 9 as string) else '' end as margin_bay_no_220kv, case when p_size % 10 = 3 then '120' else '' end as margin_220kv,
  case when p_size % 14 = 0 then 'M1' else '' end as margin_bay_no_400kv, case when p_size % 14 < 2 then '60' else '' end as margin_400kv,
  case when p_size % 6 = 1 then concat(cast(p_size % 4 as string), ' bays') else '' end as space_provision_220kv, case when p_size % 9 = 2 then 'yes' else '' end as space_provision_400kv, case when p_partkey % 23 = 5 then concat('see note ', cast(p_size as string)) else '' end as remarks
from {part}
"""
PAGE_TEXT = """
select concat('doc', cast(doc_id % 50 as string)) as source_pdf, doc_id as page_number,
  concat(case when doc_id % 2 = 0 then 'Pooling Quantum Connectivity Project Location Applicant Application ID ' else '' end,
    case when doc_id % 5 = 0 then 'Total GNARE Required ' else '' end, case when doc_id % 3 = 0 then 'GNA ST II LTA 400 kV substation ' else 'LTA LTA ' end,
    case when doc_id < 50 then concat(cast(30 + doc_id as string), 'th Consulting Meeting 11th November 2025 ') else '' end, text) as text
from {documents}
"""
LEDGER_EVENTS = """
select event_id as seq, ts, case event_type when 'view' then 'cmets' when 'click' then 'jcc' when 'signup' then 'effectiveness' else 'bayallocation' end as handler,
  concat('f', cast(user_id as string), '.pdf') as pdf_name, case when event_type = 'error' then 'failed' when value > 100 then 'completed' else 'pending' end as status, props as data_json
from {events}
"""
#: Rows of tables whose column order changes from header to header; the cells are one text, divided by bars.
TABLE_ROWS = """
select concat('doc', cast(p_partkey % 7 as string)) as source_pdf, p_partkey as row_idx,
  case when p_partkey % 97 < 7 then concat('Sl. No.|Application  ID|Name of Applicant|Installed Capacity (MW)|Expected date', case when p_partkey % 2 = 0 then ' of connectivity|Remarks' else '' end)
    when p_partkey % 97 < 14 and p_partkey % 97 >= 7 and p_size % 2 = 0 then 'Name of applicant company|Region|Total installed capacity|Application ID'
    when p_partkey % 11 = 0 then '||||'
    when p_size % 9 = 0 then concat('7|', cast(p_size as string))
    else concat(cast(p_size as string), '|', cast(1200000000 + p_partkey as string), '|', p_brand, '|', cast(p_partkey % 500 as string), '|', '05-06-2025') end as cells
from {part}
"""
#: Tables of pages: some have a target header in their first row or spread over three, some only further down, some none.
PAGE_TABLES = """
select 'tables' as source_pdf, page_number, table_no, row_idx,
  case when (table_no = page_number % 6 or (page_number % 3 = 0 and table_no = (page_number + 1) % 6)) and page_number % 2 = 0 and row_idx = 0 then 'Sl. No.|Name of  Sub-station|Bay No.'
    when table_no = page_number % 6 and page_number % 2 = 1 and row_idx < 3 then case row_idx when 0 then 'SL NO|' when 1 then 'Sub station|Coordinates' else 'Name of Entity' end
    when table_no = 4 and row_idx = 3 then 'Sl|Substation|Bay|Margin' else concat('x|', cast(row_idx as string), '|y') end as cells
from (select cast(p_partkey % 37 as int) as page_number, cast(floor(p_partkey / 37) as int) % 5 as table_no, cast(floor(p_partkey / 185) as int) as row_idx from {part})
"""
#: Listings as HTML tables of three rows with one of two headers, made of page numbers.
LISTED_REGION = "case (page_id + k) % 7 when 0 then 'Northern Region' when 1 then ' southern region' when 2 then 'Western Region' when 3 then 'EASTERN REGION' when 4 then 'North-Eastern Region' when 5 then 'North Eastern Region' else 'All India' end"
NOTICE_HREF = "concat('/uploads/meeting/n', cast(page_id % 31 as string), '.pdf')"
AGENDA_FILE = "concat(cast((page_id * 3 + k) % 120 as string), 'th_CMETS-', case k when 0 then 'NR' else 'SR' end, '_agenda_', cast(cast(floor((page_id * 3 + k) / 2) as int) as string), '.PDF')"
MINUTES_FILE = "concat('Corrigendum ', cast(page_id % 40 as string), ' CMETS ', cast(page_id * 3 + k as string), '.pdf')"
AGENDA_HREF = f"concat(case when page_id % 5 = 0 then 'https://files.example.org' else '' end, '/uploads/meeting/', {AGENDA_FILE})"
MINUTES_HREF = f"concat(case k when 2 then '/other/' else '/Uploads/meeting/' end, {MINUTES_FILE})"


def _listed_row(k: int) -> str:
    region, notice, agenda, minutes = (x.replace("+ k", f"+ {k}").replace("case k", f"case {k}") for x in (LISTED_REGION, NOTICE_HREF, AGENDA_HREF, MINUTES_HREF))
    link = lambda href, label: f"'<a target=\"x\" href=\"', {href}, '\">{label}</a>'"
    return (
        f"case page_id % 2 when 0 then concat('<tr class=\"r\"><td>{k}</td><td>m</td><td>d</td><td>', {region}, '</td><td>', {link(notice, 'Notice')}, '</td><td>', {link(agenda, 'Agenda')}, '</td><td><p>', {link(minutes, 'Minutes')}, '</p></td></tr>') "
        f"else concat('<tr><td>', {region}, '</td><td>', {link(minutes, 'MoM')}, '</td><td>', {link(agenda, 'Agenda')}, '</td><td>', {link(notice, 'Notice')}, '</td></tr>') end"
    )


LISTINGS = f"""
select page_id, concat('<html><p>Displaying</p><TABLE id="t"><tr>', case page_id % 2 when 0 then '<th>S. No.</th><th>Meeting</th><th>Date</th><th>Region</th><th>Notice</th><th> Agenda </th><th>Minutes</th>'
  else '<th> <b>Region</b></th><th>MoM</th><th>Agenda document</th><th>Meeting notice</th>' end, '</tr>', {', '.join(_listed_row(k) for k in range(3))}, '</TABLE><table><tr><td>foot</td></tr></table></html>') as html
from {{pages}}
"""
#: Titles and file names of the listings' kinds, made of page numbers.
MEETING_STEM = """case page_id % 8 when 0 then concat('1700000000123_', cast(page_id % 120 as string), 'th CMETS-NR agenda') when 1 then concat('Revised Agenda for ', cast(page_id % 120 as string), ' CMETS SR')
  when 2 then concat('Minutes_of_', cast(page_id % 120 as string), 'st_cmets_WR') when 3 then concat('Corrigendum to minutes of ', cast(page_id % 120 as string), ' CMETS') when 4 then concat('Annexure II of ', cast(page_id % 120 as string), 'nd CMETS - ER')
  when 5 then concat(cast(page_id as string), '_Notes  on connectivity') when 6 then concat('Additional Agenda-2 ', cast(page_id % 120 as string), 'rd CMETS-NER') else concat('Addendum_', cast(page_id as string), ' exhibit') end"""
COORDINATION_STEM = """case page_id % 8 when 0 then concat('Minutes of ', cast(page_id % 40 as string), 'th JCC Northern Region') when 1 then concat('07_Meeting Notice & Agenda for ', cast(page_id % 40 as string), 'ST JCCM-WR')
  when 2 then 'MoM Special JCC WR-ER-SR' when 3 then 'Notice for Special JCM Eastern Region (2)' when 4 then concat('MOM_of_', cast(page_id % 40 as string), 'nd_jcc_NER') when 5 then concat('Agenda for scheme ', cast(page_id as string))
  when 6 then concat('12_Minutes of North-Eastern JCM ', cast(page_id % 40 as string), 'rd') else 'Agenda special meeting NR/WR' end"""
CALENDAR_FILE = """case page_id % 5 when 0 then concat('12_Bidding_Calendar_as on dated 05.06.', cast(page_id % 10 + 20 as string), '.pdf') when 1 then concat('Final_Bidding Calendar 15-07-20', cast(page_id % 10 + 20 as string), '.PDF')
  when 2 then 'Draft calendar.xlsx' when 3 then concat('calendar ', cast(page_id as string)) else concat('Annexure-A approved 01-02-', cast(page_id % 10 + 20 as string), ' list.pdf') end"""
BULK_FILE = """case page_id % 6 when 0 then concat('1700000_list ', lpad(cast(page_id % 28 + 1 as string), 2, '0'), '-05-2024.pdf') when 1 then concat('Bulk 202', cast(page_id % 6 as string), '_', lpad(cast(page_id % 12 + 1 as string), 2, '0'), '.pdf')
  when 2 then concat('as of ', lpad(cast(page_id % 28 + 1 as string), 2, '0'), '062025.pdf') when 3 then 'consumers' when 4 then concat('x_202', cast(page_id % 6 as string), '02.PDF') else concat('n 202', cast(page_id % 6 as string), ' ', lpad(cast(page_id % 12 + 1 as string), 2, '0')) end"""
REVOCATION_FILE = """case page_id % 7 when 0 then concat('1234567_Revocation list upto Mar-', cast(page_id % 10 + 20 as string), '.pdf') when 1 then concat('Excluded_from list published in Jun', cast(page_id % 10 + 20 as string), '.PDF')
  when 2 then 'Revocation of connectivity.pdf' when 3 then 'excluded' when 4 then concat('Status upto May', chr(39), cast(page_id % 10 + 20 as string), '.xlsx') when 5 then concat('123456_Other__list ', cast(page_id as string), '.pdf') else '1234567.pdf' end"""
MARGIN_FILE = """case page_id % 6 when 0 then concat('1234567_Allocation of Bays_final R', cast(page_id % 9 as string), '.pdf') when 1 then concat('Non RE SS Margin-rev-', cast(page_id % 9 as string), '_approved.PDF')
  when 2 then concat('RE RE SS Margin_', cast(page_id as string), ' Final.pdf') when 3 then concat('Status of Margins  ', cast(page_id as string)) when 4 then '7654321_-.pdf' else concat('Proposed_', cast(page_id as string), '.xlsx') end"""
NCT_FILE = """case page_id % 4 when 0 then concat('minutes_', cast(page_id % 40 as string), 'TH_NCT.pdf') when 1 then concat('NCT meeting ', cast(page_id % 125 as string), '.PDF') when 2 then concat('NCT_', cast(2000 + page_id as string)) else 'agenda.pdf' end"""
STAMPED_FILE = """case page_id % 4 when 0 then concat('1234567890pdf_', cast(page_id as string), 'x') when 1 then concat('1234567 - n', cast(page_id as string)) when 2 then concat('12345_', cast(page_id as string)) else concat('123456789012PDF', cast(page_id as string), '.pdf') end"""
REPORT_TITLE = """case page_id % 9 when 0 then 'RTM projects under construction' when 1 then 'TBCB lines completed' when 2 then 'Tariff  based competitive bidding UC list' when 3 then 'Lines under construction' when 4 then 'Elements commissioned_during May'
  when 5 then 'Comm list' when 6 then 'Monthly summary' when 7 then 'TBCB overview' else 'UC_list of regulated tariff mechanism' end"""
TENDER_TITLE = """concat('Tender ', cast(page_id as string), case page_id % 8 when 0 then ' Corrigendum-1' when 1 then ' NRFP note' when 2 then ' RFP_CTS_Part A' when 3 then ' list of qualified bidders' when 4 then ' Consultant extension' when 5 then ' postponements' when 6 then ' Amendment2 to RFP' else ' map' end)"""
VIEWS = {
    "applications": (APPLICATIONS, ("orders", "customer")),
    "effectiveness": (EFFECTIVENESS, ("lineitem",)),
    "coordination": (COORDINATION, ("lineitem",)),
    "bay_cells": (BAY_CELLS, ("part",)),
    "table_rows": (TABLE_ROWS, ("part",)),
    "page_tables": (PAGE_TABLES, ("part",)),
    "listings": (LISTINGS, ("pages",)),
    "page_text": (PAGE_TEXT, ("documents",)),
    "ledger_events": (LEDGER_EVENTS, ("events",)),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of VIEWS, or a driver table as it is (`pages` serves as the link pages)."""
    if name not in VIEWS:
        return table(spark, sf_dir, name)
    sql, tables = VIEWS[name]
    return spark.sql(sql, **{t: table(spark, sf_dir, t) for t in tables})


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored model answers, one fenced or bare JSON text for each turn of a conversation."""
    row = F.to_json(F.struct(F.struct(F.col("conv_id").cast("string").alias("gna_id"), F.col("role").alias("type"), F.length("text").cast("string").alias("quantum")).alias("r")))
    one = F.expr("substring(j, 6, length(j) - 6)")
    text = (
        F.when(F.col("turn") % 4 == 0, F.concat(F.lit("```json\n{\"rows\": ["), one, F.lit("]}\n```")))
        .when(F.col("turn") % 4 == 1, F.concat(F.lit("["), one, F.lit(", "), one, F.lit("]")))
        .when(F.col("turn") % 4 == 2, F.concat(F.lit("Here it is: {\"rows\": ["), one, F.lit("]} done")))
        .otherwise(F.lit("no table on this page"))
    )
    turns = table(spark, sf_dir, "conversations")
    return turns.withColumn("j", row).select(F.concat(F.lit("doc"), F.col("conv_id").cast("string")).alias("source_pdf"), F.col("turn").cast("int").alias("page_number"), text.alias("answer"))
