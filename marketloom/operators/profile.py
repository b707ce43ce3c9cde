"""Profiles of tables: nulls, values, dates and match rates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_counts(df: DataFrame, keys, column: str) -> DataFrame:
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count_if(F.col(column).isNull()).alias("null_count"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Counts of every value, null among them."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))


def latest_dates(df: DataFrame, keys) -> DataFrame:
    """The distinct latest dates of the groups."""
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(F.max("date").alias("latest")).select("latest").distinct()


def modes(df: DataFrame, keys, column: str) -> DataFrame:
    """The most frequent value of every group, the smallest of equally frequent ones."""
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(F.mode(column, True).alias("mode"))


def match_rate(df: DataFrame, bounds: DataFrame, keys) -> DataFrame:
    """Distinct keys, how many of them have bounds, and the rate in percent."""
    own = df.dropna(subset=list(keys)).select(*keys).distinct()
    hit = own.join(bounds.select(*keys).distinct().withColumn("__hit", F.lit(1)), list(keys), "left")
    out = hit.agg(F.count(F.lit(1)).alias("distinct_keys"), F.count("__hit").alias("matched"))
    return out.withColumn("match_rate", F.try_divide(F.col("matched") * 100, F.col("distinct_keys")))


def frame_stats(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct(column).alias("distinct"), F.min("date").alias("first"), F.max("date").alias("last"))


def column_census(df: DataFrame) -> DataFrame:
    """Type, nulls and distinct values (estimated) of every column, in one pass."""
    measures = [F.struct(F.lit(c).alias("column"), F.lit(t).alias("type"), F.count_if(F.col(c).isNull()).alias("nulls"), F.approx_count_distinct(c).alias("distinct_estimate")) for c, t in df.dtypes]
    return df.agg(F.array(*measures).alias("m")).select(F.explode("m").alias("m")).select("m.*")


#: Shapes of values, the first that fits; anything else is text.
SHAPES = {"empties": "^$", "integers": r"^[+-]?[0-9]+$", "decimals": r"^[+-]?[0-9]*\.[0-9]+$", "days": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"}


def value_census(df: DataFrame) -> DataFrame:
    """Of every column: type, rows, nulls, values by their shape, and up to 16 samples of its values, in one pass.

    The samples are those values whose MD5 is the least among the ones with its first hex digit,
    in the order of their MD5: of every partition at most 16 values of a column are
    shuffled, repeats change nothing, and censuses of parts of a table can be merged.
    """
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(t).alias("type"), F.col(f"`{c}`").cast("string").alias("value")) for c, t in df.dtypes])
    rows = df.select(F.explode(cells).alias("cell")).select("cell.*").withColumn("digest", F.md5("value"))
    shape = F.when(F.col("value").isNotNull(), "texts")
    for name, pattern in reversed(SHAPES.items()):
        shape = F.when(F.col("value").rlike(pattern), name).otherwise(shape)
    rows = rows.withColumn("shape", shape)
    names = [*SHAPES, "texts"]
    parts = rows.groupBy("column", "type", F.substring("digest", 1, 1).alias("digit")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("value").isNull()).alias("nulls"),
        *[F.count_if(F.col("shape") == n).alias(n) for n in names], F.min(F.struct("digest", "value")).alias("sample"),
    )
    samples = F.array_sort(F.collect_list(F.when(F.col("digit").isNotNull(), F.col("sample"))))  # one of each digit
    return parts.groupBy("column", "type").agg(*[F.sum(n).alias(n) for n in ("rows", "nulls", *names)], samples["value"].alias("samples"))
