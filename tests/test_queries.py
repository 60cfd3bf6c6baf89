"""Every registered query with SQL equals DuckDB on the smallest tables."""

import os

import pandas as pd
import pytest

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows(df):
    df = df[sorted(df.columns)]
    null = lambda v: v is None or v is pd.NaT or (isinstance(v, float) and v != v)
    show = lambda v: None if null(v) else (round(v, 6) if isinstance(v, float) else (str(v)[:10] if hasattr(v, "year") else v))
    return sorted(repr([show(v) for v in r]) for r in zip(*[df[c].tolist() for c in df.columns]))


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def names():
    from recordweave import queries as core

    return sorted(core.QUERIES)


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")
@pytest.mark.parametrize("name", names())
def test_query(spark, duck, name):
    from recordweave import queries as core

    got = core.QUERIES[name](spark, SF).toPandas()
    if name in core.ORACLE_SQL:
        want = duck.sql(core.ORACLE_SQL[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got) == rows(want)
    else:
        assert len(got) > 0 and not got.isna().all().all()


def test_entry_imports_without_session():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
