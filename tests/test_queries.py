"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from tools.check import rows

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="tables not present")


@pytest.fixture(scope="module")
def con():
    import duckdb

    from workload.views import TABLES

    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", entry.queries())
def test_query(spark, con, name):
    df = entry.queries()[name](spark, FOLDER)
    got = rows(df.columns, df.collect())
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    result = con.sql(sql)
    assert sorted(df.columns) == sorted(result.columns)
    assert got == rows(result.columns, result.fetchall())


def test_entry(spark):
    assert entry.entry(spark).columns == ["category", "gmv_proxy", "gmv_pct", "cumulative_gmv_pct"]
