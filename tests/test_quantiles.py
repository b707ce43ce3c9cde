"""Exact quantiles from counts against numpy, and plans without a buffer of a group's prices."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketloom.operators import outliers, weekly
from marketloom.operators.quantiles import bin_of, weighted_quantiles

WANTED = {"low": 0.0, "a": 0.1, "q1": 0.25, "m": 0.5, "q3": 0.75, "z": 0.99, "high": 1.0}


def test_quantiles_against_numpy(spark):
    rng = random.Random(3)
    value = lambda k: rng.choice((round(rng.gauss(0, 10.0**k), 3), 0.0, 1000.0, 999.999, -1e-7, 5e9))
    rows = [(g, value(k)) for k, g in enumerate("abcd") for _ in range(rng.randrange(1, 400))]
    rows += [("one", 7.0), (None, 3.0), (None, 5.0), ("none", None), ("nan", float("nan")), ("a", None), ("a", float("nan"))]
    got = weighted_quantiles(spark.createDataFrame(rows, "g string, v double").repartition(6), ["g"], "v", WANTED)
    groups = {g: [v for h, v in rows if h == g and v is not None and v == v] for g in {g for g, _ in rows}}
    found = {r["g"]: [r[n] for n in WANTED] for r in got.collect()}
    assert found.keys() == {g for g, v in groups.items() if v}
    for g, values in found.items():
        np.testing.assert_allclose(values, np.quantile(groups[g], list(WANTED.values())), rtol=1e-12)


def test_bins_never_fall(spark):
    rng = random.Random(4)
    values = sorted({rng.choice((-1, 1)) * rng.random() * 10.0 ** rng.randrange(-9, 12) for _ in range(4000)} | {10.0**k for k in range(-9, 12)} | {0.0, 99.0, 100.0, 0.3, 0.29})
    bins = [r["b"] for r in spark.createDataFrame([(v,) for v in values], "v double").select("v", bin_of(F.col("v")).alias("b")).orderBy("v").collect()]
    assert all(a <= b for a, b in zip(bins, bins[1:], strict=False))


def test_a_hot_group_is_spread(spark):
    df = spark.range(200_000).select(F.lit("x").alias("g"), (F.col("id") % 50_021).cast("double").alias("v"))
    got = weighted_quantiles(df, ["g"], "v", WANTED).first()
    np.testing.assert_allclose([got[n] for n in WANTED], np.quantile(np.arange(200_000) % 50_021, list(WANTED.values())))


@pytest.mark.parametrize("hot", [True, False])
def test_weekly_and_statistics_agree_for_both_ways(spark, hot):
    rows = [("A", "r", "2024-01-07", 3.0), ("A", "r", "2024-01-07", 5.0), ("A", "s", "2024-01-14", None), (None, "r", "2024-01-07", 1.0), ("B", "r", None, 2.0)]
    df = spark.createDataFrame(rows, "brand string, reference_number string, date string, price double").withColumn("date", F.to_date("date"))
    df = df.withColumns({"currency": F.lit("USD"), "source": F.lit("s"), "hash_id": F.monotonically_increasing_id()})
    got = sorted(((r["brand"], str(r["date"]), r["median_price"], r["count"]) for r in weekly.weekly(df, "brand", hot=hot).collect()), key=str)
    assert got == [("A", "2024-01-07", 4.0, 2), ("A", "2024-01-14", None, 1), ("B", "None", 2.0, 1)]
    stats = {r["brand"]: (r["count"], r["q1"], r["q2"], r["q3"], r["iqr"], r["min"]) for r in outliers.group_statistics(df, ["brand"], hot=hot).collect()}
    assert stats == {"A": (3, 3.5, 4.0, 4.5, 1.0, 3.0), "B": (1, 2.0, 2.0, 2.0, 0.0, 2.0)}


def test_no_buffer_of_prices_in_the_plan(spark):
    df = spark.createDataFrame([], "brand string, date date, price double, currency string, source string, hash_id string, reference_number string")
    for out in (weekly.weekly(df, "brand"), outliers.group_statistics(df, ["brand"])):
        plan = out._jdf.queryExecution().optimizedPlan().toString().lower()
        assert "percentile(" not in plan and "median(" not in plan
