"""How long listings stay on the market."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.functions.text import identifier, slug
from marketloom.operators.weekly import first_non_null


def lifetimes(df: DataFrame, order: str = "hash_id") -> DataFrame:
    """First and last date of every url, with the days between (0 counts as 7) and whether it is still listed."""
    urls = df.where("watch_url IS NOT NULL").groupBy("watch_url").agg(
        F.min("date").alias("first_seen"), F.max("date").alias("last_seen"),
        first_non_null("brand", order).alias("brand"), first_non_null("reference_number", order).alias("reference_number"),
    )
    days = F.datediff("last_seen", "first_seen")
    urls = urls.withColumn("days", F.when(days == 0, 7).otherwise(days))
    return urls.withColumn("active", F.col("last_seen") == df.agg(F.max("date")).scalar())


def durations_by_model(df: DataFrame, order: str = "hash_id") -> DataFrame:
    """By brand and reference, null ones too: number of urls, and of the delisted ones number, statistics of days and weeks and last date."""
    urls = lifetimes(df, order).withColumn("weeks", F.round(F.col("days") / 7, 1))
    gone = lambda c: F.when(~F.col("active"), F.col(c))
    stats = [("mean", F.avg), ("median", F.median), ("std", F.stddev_samp), ("min", F.min), ("max", F.max)]
    return urls.groupBy("brand", "reference_number").agg(
        F.count(F.lit(1)).alias("urls"), F.count_if(~F.col("active")).alias("count"),
        *[f(gone(c)).alias(f"{name}_{c}") for c in ("days", "weeks") for name, f in stats],
        F.max(gone("last_seen")).alias("date"),
    )


def of_models(models: DataFrame) -> DataFrame:
    """The rows of ``durations_by_model`` that name brand and reference and have delisted urls."""
    own = models.where("count > 0").dropna(subset=["brand", "reference_number"]).drop("urls")
    return own.withColumn("identifier", identifier(slug(F.col("brand")), F.col("reference_number")))


def listing_durations(df: DataFrame, order: str = "hash_id") -> DataFrame:
    """Statistics of the days and weeks that delisted urls stayed, by brand and reference."""
    return of_models(durations_by_model(df, order))


def duration_report(df: DataFrame, stats: DataFrame) -> DataFrame:
    """One row: urls in all, delisted and active, models, and the means of their mean and median days."""
    return _report(lifetimes(df).agg(F.count(F.lit(1)).alias("urls"), F.count_if(~F.col("active")).alias("inactive")), stats)


def _report(urls: DataFrame, stats: DataFrame) -> DataFrame:
    models = stats.agg(F.count(F.lit(1)).alias("models"), F.avg("mean_days").alias("mean_of_means"), F.avg("median_days").alias("mean_of_medians"))
    return urls.crossJoin(models).withColumn("active", F.col("urls") - F.col("inactive"))


def top_models(stats: DataFrame, column: str, n: int = 5) -> DataFrame:
    return stats.orderBy(F.desc_nulls_last(column), "brand", "reference_number").limit(n)


def full_report(df: DataFrame, stats: DataFrame, n: int = 5) -> DataFrame:
    """``duration_report`` and the ``n`` models that stay longest and that have most urls, as lists of (brand, reference_number, value)."""
    return _with_tops(duration_report(df, stats), stats, n)


def full_report_of_models(models: DataFrame, n: int = 5) -> DataFrame:
    """The same from the rows of ``durations_by_model``, which are read several times: write them first."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    stats = of_models(models)
    return _with_tops(_report(models.agg(total("urls").alias("urls"), total("count").alias("inactive")), stats), stats, n)


def _with_tops(out: DataFrame, stats: DataFrame, n: int) -> DataFrame:
    for name, column in (("longest", "mean_days"), ("most_urls", "count")):
        value = F.col(column).cast("double")
        rows = top_models(stats, column, n).select(F.struct((-value).alias("order"), "brand", "reference_number", value.alias("value")).alias("row"))
        found = F.transform(F.array_sort(F.collect_list("row")), lambda r: F.struct(r["brand"].alias("brand"), r["reference_number"].alias("reference_number"), r["value"].alias("value")))
        out = out.withColumn(name, rows.agg(found.alias(name)).scalar())  # n rows
    return out
