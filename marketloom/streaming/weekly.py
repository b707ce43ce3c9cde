"""Listings as a stream: late repeats dropped, weeks counted with a watermark, batch plans run by micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def weekly_stream(events: DataFrame, key: str, value: str, time: str = "ts", late: str = "7 days", unique: str | None = None) -> DataFrame:
    """Weekly count, mean, high and low by key of a stream; rows later than ``late`` are left out, repeats too if ``unique`` names an id."""
    marked = events.withWatermark(time, late)
    if unique:
        marked = marked.dropDuplicatesWithinWatermark([unique])
    # Weeks of the epoch begin on a Thursday; four days on, they run from Monday to the Monday after the Sunday they are named by.
    week = F.window(time, "7 days", startTime="4 days")
    out = marked.groupBy(week, key).agg(
        F.count(F.lit(1)).alias("count"), F.avg(value).alias("mean"), F.max(value).alias("high"), F.min(value).alias("low")
    )
    return out.select(F.date_sub(F.to_date("window.end"), 1).alias("date"), key, "count", "mean", "high", "low")


def run_by_batch(stream: DataFrame, job: Callable[[DataFrame], None], checkpoint: str) -> StreamingQuery:
    """Run a batch job over everything that is there now; a batch that ran is not run again after a restart."""
    return stream.writeStream.foreachBatch(lambda df, _: job(df)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
