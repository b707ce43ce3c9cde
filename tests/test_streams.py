"""Micro-batches that are stopped and replayed, and lifetimes kept as a stream, against the batch results."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from marketloom.operators import liquidity, series, weekly
from marketloom.streaming import history
from marketloom.streaming.lifetimes import lifetimes_stream

EVENTS = "/root/testdata/sf0.01/events.parquet"


def test_weeks_after_a_stop_and_a_replay_equal_the_batch(spark, tmp_path, monkeypatch):
    rng = random.Random(6)
    day = lambda: dt.date(2024, 1, 7) + dt.timedelta(days=7 * rng.randrange(8))
    rows = [(rng.choice("AB"), rng.choice(["x", "y", None]), day(), rng.choice([None, 1.0, 2.0, 5.5, 9.0]), str(k)) for k in range(400)]
    schema = "brand string, parent_model string, date date, price double, hash_id string"
    for k in range(4):
        spark.createDataFrame(rows[k::4], schema).coalesce(1).write.parquet(str(tmp_path / f"in/{k}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in/*"))
    keys, folder, checkpoint = ["brand", "parent_model"], str(tmp_path / "out"), str(tmp_path / "checkpoint")
    ran, write = [], history.write_weeks

    def failing(df, path):
        ran.append(path)
        if len(ran) == 2:
            raise RuntimeError("stopped after the batch's counts were written")
        write(df, path)

    monkeypatch.setattr(history, "write_weeks", failing)
    with pytest.raises(Exception, match="stopped after"):
        history.follow_weeks(stream, keys, folder, checkpoint).awaitTermination()
    history.follow_weeks(stream, keys, folder, checkpoint).awaitTermination()
    assert len(ran) == 5  # four batches, one of them twice
    df = spark.createDataFrame(rows, schema).withColumns({"currency": F.lit("USD"), "source": F.lit("s")})
    whole = weekly.weekly(df, "parent_model").select("brand", "parent_model", "date", "median_price", "mean_price", "high", "low", "count")
    got = spark.read.parquet(f"{folder}/weeks").select(*whole.columns)
    flat = lambda x: sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in x.collect())
    assert flat(got) == flat(whole)
    rolled = [series.rolling_average(x.withColumn(series.ROLLING, F.lit(None).cast("double")), keys) for x in (got, whole)]
    assert flat(rolled[0]) == flat(rolled[1])
    history.add_batch(spark.createDataFrame(rows[3::4], schema), keys, folder, 3)
    history.add_batch(spark.createDataFrame(rows[:0], schema), keys, folder, 9)
    assert spark.read.parquet(f"{folder}/weeks").count() == whole.count()


def test_lifetimes_of_events_in_three_batches_equal_the_batch(spark, tmp_path):
    events = spark.read.parquet(EVENTS).select("user_id", "ts")
    low, high = events.agg(F.min("ts"), F.max("ts")).first()
    third, lost = (high - low) / 3, (10**6, low)
    for k in range(3):
        part = events.where((F.col("ts") >= low + k * third) & ((F.col("ts") < low + (k + 1) * third) if k < 2 else F.lit(True)))
        part = part if k else part.union(spark.createDataFrame([(None, low), lost], events.schema))
        part.coalesce(1).write.parquet(str(tmp_path / f"in/{k}"))
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in/*"))
    found = lifetimes_stream(stream, "user_id", late="1 hour", gone_after="10 days")
    seen = []
    found.writeStream.outputMode("update").foreachBatch(lambda df, n: seen.extend((n, *r) for r in df.collect())).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    last = {}
    for n, user, *rest in sorted(seen, key=lambda r: (r[0], r[1])):
        last[user] = tuple(rest)
    urls = events.union(spark.createDataFrame([lost], events.schema)).select(F.col("user_id").cast("string").alias("watch_url"), F.to_date("ts").alias("date"), F.lit("b").alias("brand"), F.lit("r").alias("reference_number"), F.lit("h").alias("hash_id"))
    want = {int(r["watch_url"]): (r["first_seen"], r["last_seen"], r["days"]) for r in liquidity.lifetimes(urls).collect()}
    assert {u: v[:3] for u, v in last.items()} == want
    assert last[lost[0]][3] is False and sum(v[3] for v in last.values()) > 0
