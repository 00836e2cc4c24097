import os

import duckdb
import pytest

import __spark_entry__ as e
from carbonsieve.plans import catalog

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test data here")


def plain(v):
    return float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(SMALL):
        c.sql(f"create view {f.split('.')[0]} as select * from '{SMALL}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_gives_the_rows_of_its_sql(spark, duck, name):
    df = catalog.queries()[name](spark, SMALL)
    want = duck.sql(catalog.oracle_sql()[name])
    assert sorted(df.columns) == sorted(want.columns)
    cols = sorted(df.columns)
    got = sorted(str([plain(r[c]) for c in cols]) for r in df.collect())
    at = [want.columns.index(c) for c in cols]
    assert got == sorted(str([plain(r[i]) for i in at]) for r in want.fetchall())


def test_entry(spark):
    df = e.entry(spark)
    assert df.columns == ["id", "company_id", "reporting_year", "review_status", "flag_reason"] and df.count() > 0


def test_every_oracle_has_a_query():
    assert set(e.oracle_sql()) <= set(e.queries())
