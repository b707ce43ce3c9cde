"""Every registered listing query against its SQL in DuckDB on the smallest tables."""

import datetime as dt
import math
from pathlib import Path

import duckdb
import pytest

from marketloom.plans import catalog

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return "null"
    if isinstance(v, dt.datetime | dt.date):
        return str(v)[:10]
    return f"{float(v):.9g}" if isinstance(v, float | int) and not isinstance(v, bool) else str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    got = catalog.QUERIES[name](spark, SF)
    names = sorted(got.columns)
    want = duck.sql(catalog.ORACLES[name])
    assert names == sorted(want.columns)
    rows = sorted(tuple(plain(r[c]) for c in names) for r in got.collect())
    at = [want.columns.index(c) for c in names]
    assert rows == sorted(tuple(plain(r[i]) for i in at) for r in want.fetchall())


@pytest.mark.parametrize("name", ["weeks_merged", "clean_chain", "weekly_parent"])
def test_large_sides_are_hashed_over_tasks(spark, duck, monkeypatch, name):
    """The same rows where sides are too large for a broadcast; line items are not sorted to meet them."""
    monkeypatch.setattr(catalog, "MAX_LEFT_TO_SPARK", 100, raising=False)
    monkeypatch.setattr(catalog, "ROWS_A_TASK", 1000, raising=False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = catalog.listings(spark, SF).where("date IS NOT NULL")._jdf.queryExecution().executedPlan().toString()
        # 6000 line items and 1500 orders, or 200 parts; supplier and nation have few rows.
        assert plan.count("ShuffledHashJoin") == 2 and ", 8), REPARTITION_BY_NUM" in plan and ", 7), REPARTITION_BY_NUM" in plan
        test_query(spark, duck, name)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
