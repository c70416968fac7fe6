"""Every query with SQL against DuckDB, over the smallest table."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from thermolake.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")


def cell(x):
    if x is None or x != x:
        return "~"
    return repr(round(float(x), 5)) if isinstance(x, float) else str(x)[:10] if hasattr(x, "year") else str(x)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query(spark, name):
    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = registry.queries()[name](spark, SF)
    want = con.sql(registry.oracle_sql()[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    rows = lambda table: sorted(tuple(cell(x) for x in r) for r in table)
    assert rows(got.select(columns).collect()) == rows(want.select(*columns).fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_rows(spark, name):
    assert registry.queries()[name](spark, SF).count() > 0
