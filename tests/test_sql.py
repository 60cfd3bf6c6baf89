"""Queries against their SQL on small tables with values that the driver tables have only at larger sizes."""

import datetime

import pandas as pd
import pytest

from tests.test_queries import rows

DAY = datetime.datetime(1995, 3, 4)


def line(order: int, part: int, supplier: int, number: int = 1) -> dict:
    return {"l_orderkey": order, "l_partkey": part, "l_suppkey": supplier, "l_linenumber": number, "l_quantity": 5.0, "l_extendedprice": 1.0, "l_discount": 0.0, "l_tax": 0.0, "l_returnflag": "R", "l_linestatus": "F", "l_shipdate": DAY}


@pytest.fixture
def both(spark, tmp_path):
    """(the query's rows, its SQL's rows) over tables of these rows."""

    def run(name: str, **tables: list[dict]):
        import duckdb

        from recordweave import queries as core

        con = duckdb.connect()
        for t, made in tables.items():
            spark.createDataFrame(pd.DataFrame(made)).coalesce(1).write.parquet(f"{tmp_path}/{t}.parquet")
            con.sql(f"create view {t} as select * from '{tmp_path}/{t}.parquet/*.parquet'")
        got, want = core.QUERIES[name](spark, str(tmp_path)).toPandas(), con.sql(core.ORACLE_SQL[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        return rows(got), rows(want)

    return run


def test_id_hits_equal_sql_where_an_identifier_spans_two_numbers(both):
    # supplier#1200 (1200120005) holds 1200120012, which is the identifier of order 120,012
    got, want = both("a10_d6_id_hits", lineitem=[line(120_005, 1, 1200), line(120_012, 2, 7)])
    assert got == want and len(got) == 3


def test_bay_numbers_equal_sql_where_a_bay_has_a_voltage_as_its_number(both):
    got, want = both("c27_bay_numbers", lineitem=[line(4, 1, 219), line(8, 1, 399), line(12, 1, 6), line(13, 1, 6)])
    assert got == want == ["['', 13]", "['', 4]", "['', 8]", "['7', 12]"]


def test_page_scan_equals_sql_beyond_ten_thousand_pages(both):
    got, want = both("s1_page_scan", documents=[{"doc_id": k, "text": "x", "lang": "en", "source": "s", "n_chars": 1} for k in (50, 9_950, 10_000, 10_050, 25_000)])
    assert got == want == ["[25000, 5, 'doc0']"]
