"""Volatility of prices over calendar periods."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.functions import calendar
from marketloom.functions.text import identifier, slug

# Weeks of history that an interval needs, and its periods a year.
MIN_WEEKS = {"1M": 52, "3M": 104, "6M": 104, "1Y": 156}
PERIODS = {"1M": 12, "3M": 4, "6M": 2, "1Y": 1}


def qualifying(df: DataFrame, keys, weeks: int) -> DataFrame:
    """Rows of the groups whose dates span at least so many whole weeks."""
    spans = df.dropna(subset=list(keys)).groupBy(*keys).agg(F.datediff(F.max("date"), F.min("date")).alias("__days"))
    return df.join(spans.where(F.floor(F.col("__days") / 7) >= weeks).drop("__days"), list(keys), "left_semi")


def _bin(interval: str, first: Column) -> tuple[Column, Column]:
    """Number and last day of the period that a date falls in."""
    d = F.col("date")
    if interval == "1M":
        return F.year(d) * 12 + F.month(d), calendar.month_end(d)
    if interval == "3M":
        return calendar.quarter_index(d), calendar.quarter_end(d)
    if interval == "6M":
        return calendar.two_quarter_index(d, first), calendar.two_quarter_end(d, first)
    return F.year(d), calendar.year_end(d)


def resample(df: DataFrame, keys, interval: str, price: str) -> DataFrame:
    """Open, close, mean, median, high and low of every period, with returns.

    The log return is null beside an empty period; the change of the mean looks over it.
    """
    first = F.min("date").over(Window.partitionBy(*keys))
    with_first = df.dropna(subset=list(keys)).withColumn("__first", first)
    number, label = _bin(interval, F.col("__first"))
    out = with_first.withColumns({"bin": number, "period_end": label}).groupBy(*keys, "bin", "period_end").agg(
        F.min_by(price, F.when(F.col(price).isNotNull(), F.col("date"))).alias("open"),
        F.max_by(price, F.when(F.col(price).isNotNull(), F.col("date"))).alias("close"),
        F.avg(price).alias("mean_price"), F.median(price).alias("median_price"),
        F.max(price).alias("high"), F.min(price).alias("low"),
    )
    w = Window.partitionBy(*keys).orderBy("bin")
    mean = F.last("mean_price", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    before = F.last("mean_price", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    neighbour = F.lag("bin").over(w) == F.col("bin") - 1
    close = F.lag("close").over(w)
    return out.withColumns(
        {
            "pct_change": F.try_divide(mean - before, before) * 100,
            "log_return": F.when(neighbour & (close > 0) & (F.col("close") > 0), F.ln(F.col("close") / close)),
        }
    )


def volatility(df: DataFrame, keys=("brand", "reference_number"), price: str = "rolling_avg_of_median_price", min_weeks: dict | None = None) -> DataFrame:
    """Yearly volatility in percent by interval: one row for each group that qualifies for one.

    The rows are put into the periods of all intervals at once, so the groups are shuffled once.
    """
    weeks, whole = MIN_WEEKS if min_weeks is None else min_weeks, Window.partitionBy(*keys)
    spans = df.dropna(subset=list(keys)).withColumns({"__first": F.min("date").over(whole), "__last": F.max("date").over(whole)})
    known = F.floor(F.datediff("__last", "__first") / 7)
    bins = [F.when(known >= least, F.struct(F.lit(i).alias("interval"), _bin(i, F.col("__first"))[0].cast("int").alias("bin"))) for i, least in weeks.items()]
    rows = spans.select(*keys, "date", price, F.explode(F.array_compact(F.array(*bins))).alias("__bin")).select(*keys, "date", price, "__bin.*")
    last = F.max_by(price, F.when(F.col(price).isNotNull(), F.col("date")))
    closes = rows.groupBy(*keys, "interval", "bin").agg(last.alias("close"))
    w = Window.partitionBy(*keys, "interval").orderBy("bin")
    close, neighbour = F.lag("close").over(w), F.lag("bin").over(w) == F.col("bin") - 1
    returns = closes.withColumn("log_return", F.when(neighbour & (close > 0) & (F.col("close") > 0), F.ln(F.col("close") / close)))
    of = lambda i: F.stddev_samp(F.when(F.col("interval") == i, F.col("log_return"))) * F.sqrt(F.lit(PERIODS[i])) * 100
    wide = returns.groupBy(*keys).agg(*[of(i).alias(f"volatility_{i.lower()}") for i in PERIODS])
    return wide.withColumn("brand_slug", slug(F.col(keys[0]))).withColumn("identifier", identifier(F.col("brand_slug"), F.col(keys[-1])))
