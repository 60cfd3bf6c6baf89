"""Table-driven checks of the column functions."""

import datetime

import pytest
from pyspark.sql import functions as F

from recordweave.functions import names as N
from recordweave.functions import numbers as V
from recordweave.functions import text as T

CASES = [
    ("project_type", lambda c: T.project_type(c), [("solar (300)", "Solar (300)"), ("Wind (12) + BESS (19)", "Wind (12) + BESS (19)"), ("Hybrid (500)", "Solar+Wind (500)"), ("Hybrid + BESS", "Solar+Wind + BESS"), ("Generator (Solar)", "Solar"), ("Thermal", None), (None, None)]),
    ("clean", lambda c: T.clean(c), [(" x ", "x"), ("N/A", None), ("--", None), ("", None), (None, None)]),
    ("numeric_ids", lambda c: T.numeric_ids(c, True), [("id 0412345, 000000", "412345, 0"), ("none here", "none here"), (None, None)]),
    ("state", lambda c: T.state(c), [("x distt, Uttar Pradesh", "uttar pradesh"), ("place, Atlantis.", "atlantis"), ("place", None)]),
    ("status", lambda c: T.status(c), [("Withdrawn on", "Withdrawn"), ("revoked", "Revoked"), ("Granted", "granted"), ("other", "other")]),
    ("voltage", lambda c: T.voltage_text(c), [("at 400KV", "400 kV"), ("odd", "odd")]),
    ("name_key", lambda c: T.name_key(c), [("A.B. Power Pvt. Ltd.", "a b power"), ("X Limited", "x"), ("Powerica Ltd. (50.6)", "powerica ltd 50 6")]),
    ("bays", lambda c: T.bay_numbers(c), [("Bay no. 5 & 220", "5"), ("bays allocated: 7A, 8 and 9", "7A | 8 | 9"), ("line", "")]),
    ("gna_total", lambda c: V.total(V.all_mw(c)), [("300 MW: 15.06.2025", 300.0), ("1,200.5 MW and 10MW", 1210.5), ("none", None)]),
    ("strict", lambda c: V.total(V.commissioned_mw(c, strict=True)), [("111.8 MW: 19.05.2025 (Commissioned)\n88.2 MW: 01.06.2025 (Commissioned)\n100 MW: 30.09.2025", 200.0)]),
    ("leftmost", lambda c: V.total(V.commissioned_mw(c)), [("100 MW: 30.09.2025\n88.2 MW: 1.1.2025 (Commissioned)", 100.0)]),
    ("parse", lambda c: V.parse_date(c), [("31-12-2025", datetime.date(2025, 12, 31)), ("2025/02/31", None), ("5 March 2024", datetime.date(2024, 3, 5)), ("31.02.2024", None), ("n/a", None)]),
    ("meeting", lambda c: V.meeting_number(c), [("42nd Consulting Meeting", "42"), ("CMETS_NR/42", "42"), ("meeting no. 7", "7"), ("none", None)]),
    ("held", lambda c: V.meeting_date(c), [("11th November 2025 (Tuesday)", "11.11.2025"), ("November 3, 2025", "03.11.2025"), ("11/2025", None)]),
    ("best_voltage", lambda c: T.best_voltage(T.voltages_in(c)), [("220kV 400 kV 220 kV", "220 kV"), ("400kV or 220 kV", "400 kV"), ("11 kV", "11 kV"), ("x", None)]),
    ("file", lambda c: N.url_file_name(c), [("http://a.b/c/My%20File.pdf?x=1", "My File.pdf"), ("http://a.b/x+y.pdf", "x+y.pdf")]),
    ("bulk", lambda c: N.bulk_name(c), [("1699999_as on 05-06-2024.PDF", "Bulk Consumer 05-06-2024.pdf"), ("list 2024_02", "Bulk Consumer 28-02-2024.pdf"), ("June 202306.pdf", "Bulk Consumer 30-06-2023.pdf"), ("as of 05062025.pdf", "Bulk Consumer 05-06-2025.pdf"), ("list.xlsx", "Bulk Consumer.xlsx")]),
    ("meeting_label", lambda c: N.meeting_label(c), [("1690000000000_35th_CMETS-NR", "35th CMETS-NR"), ("Revised Agenda of 7 cmets sr", "Revised Agenda_7th CMETS-SR"), ("Corrigendum 12 CMETS", "Minutes Corrigendum_12th CMETS"), ("2_Additional Agenda-1 41st CMETS WR", "Additional Agenda_41st CMETS-WR"), ("Annexure  notes", "Annex_Annexure notes"), ("Some  note", "Some note")]),
    ("coordination", lambda c: N.coordination_label(c, F.lit(False)), [("01_Minutes of 12th JCC of Northern Region", "12th JCC-NR"), ("MoM_Special JCC WR-ER-SR", "Special JCC WR-SR"), ("Minutes of special JCM eastern", "Special JCM-ER"), ("MOM of 3RD JCCM-ner (1)", "3rd JCCM-NER"), ("Minutes of scheme 4", "scheme 4")]),
    ("coordination_notice", lambda c: N.coordination_label(c, F.lit(True)), [("Meeting Notice & Agenda for 21st JCC-WR", "21st JCC-WR"), ("Agenda for the scheme", "the scheme")]),
    ("calendar", lambda c: N.calendar_name(c), [("12_Bidding_Calendar_as on 05.06.25.pdf", "Bidding Calendar 05-06-2025.pdf"), ("Final list 01-02-2024.PDF", "Bidding Calendar 01-02-2024.pdf"), ("calendar", "Bidding Calendar.pdf")]),
    ("revocation", lambda c: N.revocation_name(c), [("1234567_Revocation list upto May'26.pdf", "Revocation upto may26.pdf"), ("Excluded published in Jun25.pdf", "Excluded from upto jun25.pdf"), ("upto Mar-26", "Revocation upto mar26.pdf"), ("Excluded", "Excluded from.pdf"), ("123456_Other__list.PDF", "Other list.pdf"), ("1234567.pdf", "file.pdf")]),
    ("margin", lambda c: N.margin_name(c), [("Allocation of Bays_final R3.pdf", "Allocation of Bays.pdf"), ("Non RE SS Margin-rev-2_Approved.pdf", "Non RE SS Margin.pdf"), ("RE RE SS Margin_May.pdf", "RE SS Margin May.pdf"), ("Status of Margins  May.pdf", "Status of Margins May.pdf"), ("Proposed_list", "Proposed list.pdf")]),
    ("nct", lambda c: N.nct_name(c), [("Minutes_21ST_NCT.pdf", "21st_NCT_MoM.pdf"), ("NCT 12 meeting.PDF", "12th_NCT_MoM.pdf"), ("NCT_2024", "NCT 2024.pdf")]),
    ("report", lambda c: N.report_category(c, F.lit("a.pdf")), [("RTM under construction", "rtm_uc"), ("TBCB completed", "tbcb_completed"), ("Tariff based  competitive bidding UC", "tbcb_uc"), ("Comm list", "tbcb_completed"), ("commissioned_in May", None), ("summary", None)]),
    ("keyword", lambda c: N.keyword_in(c), [("RFP_CTS_Part A", "RFP"), ("NRFP", None), ("amendment to rfp", "RFP"), ("qualified", "Qualified")]),
]


@pytest.mark.parametrize("name,make,rows", CASES, ids=[x[0] for x in CASES])
def test_function(spark, name, make, rows):
    df = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(rows)], "i int, v string")
    got = [r[0] for r in df.orderBy("i").select(make(F.col("v"))).collect()]
    assert got == [b for _, b in rows]


def test_technology_sums(spark):
    df = spark.createDataFrame([("Wind (12) + BESS (44)",), ("Solar",), (None,)], "v string")
    got = [tuple(r) for r in df.select(*[V.technology_mw(F.col("v"))[k] for k in ("wind", "ess", "solar")]).collect()]
    assert got == [(12.0, 44.0, None), (None, None, 0.0), (None, None, None)]


def test_enhancement_id(spark):
    rows = [("Enhancement 1200000001", None, None, None), (None, "1200000001", None, None), (None, "5.2 0412000001 1300000001", None, None), (None, None, "0412000001", "revision")]
    df = spark.createDataFrame(rows, "e string, g string, l string, m string")
    assert [r[0] for r in df.select(T.enhancement_id(*[F.col(x) for x in "eglm"])).collect()] == ["1200000001", None, "1300000001", None]
