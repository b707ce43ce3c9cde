"""Weekly prices that grow by micro-batches, each of which counts once however often it runs.

What is kept of a batch are counts by (keys, week, price), under the batch's own number: a
batch that is run again after a failure replaces its own counts. Prices of a week are taken
from the counts of all batches, so medians are exact and don't depend on how the listings
were dealt to batches; only the weeks that a batch touches are written again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marketloom.operators.quantiles import with_quantiles
from marketloom.sources.listings import write_weeks


def price_counts(listings: DataFrame, keys: list[str]) -> DataFrame:
    """keys, date, price and n, how many listings have them; rows without a key or a date are left out."""
    own = listings.dropna(subset=[*keys, "date"])
    return own.groupBy(*keys, "date", F.col("price").cast("double").alias("price")).agg(F.count(F.lit(1)).alias("n"))


def weeks_from_counts(counts: DataFrame, keys: list[str]) -> DataFrame:
    """Weekly rows from the counts of any number of batches: median, mean, high, low and count (of rows with and without a price)."""
    group = [*keys, "date"]
    total = F.sum(F.when(F.col("price").isNotNull(), F.col("n")))
    stats = counts.groupBy(*group).agg(
        (F.sum(F.col("price") * F.col("n")) / total).alias("mean_price"), F.max("price").alias("high"), F.min("price").alias("low"), F.sum("n").alias("count")
    )
    return with_quantiles(stats, counts, group, "price", {"median_price": 0.5}, weight="n")


def add_batch(listings: DataFrame, keys: list[str], folder: str, batch: int) -> None:
    """Take a batch into the tables ``counts`` and ``weeks`` of a folder; the same number again replaces what it was."""
    spark, counts = listings.sparkSession, f"{folder}/counts"
    own = price_counts(listings, keys).withColumn("batch", F.lit(batch))
    own.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch", "date").parquet(counts)
    known = spark.read.schema(own.schema).parquet(counts)
    touched = known.where(F.col("batch") == batch).select("date").distinct()
    write_weeks(weeks_from_counts(known.join(touched, "date", "left_semi"), keys), f"{folder}/weeks")


def follow_weeks(stream: DataFrame, keys: list[str], folder: str, checkpoint: str) -> StreamingQuery:
    """Take in all listings of a stream that are there now, batch by batch; after a stop it goes on where it was."""

    def job(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            add_batch(batch, keys, folder, number)

    return stream.writeStream.foreachBatch(job).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
