"""Price boundaries from quartiles, and filtering by them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketloom.functions.text import is_nullish
from marketloom.operators.quantiles import with_quantiles
from marketloom.schema import PRE_OWNED

# Multiples of the interquartile range, (upper, lower) by brand.
MULTIPLIERS = {
    "Audemars Piguet": (10, 4.5), "Breitling": (4, 2.5), "Cartier": (10, 4), "Frederique Constant": (4, 4),
    "Hamilton": (5, 2.5), "Longines": (4.5, 2.5), "Omega": (3.5, 2), "Patek Philippe": (4, 2.5), "Panerai": (4, 3),
    "Rolex": (10, 4), "Seiko": (5, 3.5), "Tudor": (10, 4),
}
DEFAULT_MULTIPLIERS = (4, 2.5)


def group_statistics(df: DataFrame, keys: list[str], price: str = "price", hot: bool | None = None) -> DataFrame:
    """Count, quartiles (linear), range and IQR of every group; null keys make no group.

    The quartiles of ``hot`` groups, which may hold a large part of all rows (by default those
    of one key), are taken from counts of prices, others from the prices of the group.
    """
    own, shares = df.dropna(subset=keys), {"q1": 0.25, "q2": 0.5, "q3": 0.75}
    ends = [F.count(F.lit(1)).alias("count"), F.min(price).alias("min"), F.max(price).alias("max")]
    if len(keys) == 1 if hot is None else hot:
        stats = with_quantiles(own.groupBy(*keys).agg(*ends), own, keys, price, shares)
    else:
        q = F.percentile(price, F.array(*map(F.lit, shares.values())))
        stats = own.groupBy(*keys).agg(*ends, q.alias("q"))
        stats = stats.withColumns({name: F.get("q", F.lit(i)) for i, name in enumerate(shares)}).drop("q")
    return stats.withColumn("iqr", F.col("q3") - F.col("q1"))


def with_category(stats: DataFrame) -> DataFrame:
    n = F.col("count")
    named = F.when((n > 0) & (n <= 10), "insufficient").when((n > 10) & (n <= 20), "caution").when(n > 20, "confidence")
    return stats.withColumn("category", named)


def thresholds(stats: DataFrame, by_reference: bool, multipliers: dict | None = None) -> DataFrame:
    """lower_boundary and upper_boundary of groups with a category; null where the count is insufficient."""
    chosen = MULTIPLIERS if multipliers is None else multipliers
    upper, lower = F.lit(float(DEFAULT_MULTIPLIERS[0])), F.lit(float(DEFAULT_MULTIPLIERS[1]))
    for brand, (u, w) in chosen.items():
        upper = F.when(F.col("brand") == brand, float(u)).otherwise(upper)
        lower = F.when(F.col("brand") == brand, float(w)).otherwise(lower)
    if by_reference:
        reach = F.when(F.col("category") == "caution", F.lit(2.0)).otherwise(lower)
        least = F.greatest(F.col("q1") - reach * F.col("iqr"), F.col("q2") * 0.125)
    else:
        least = F.col("q2") * 0.15
    enough = F.col("category") != "insufficient"
    return stats.withColumns(
        {"lower_boundary": F.when(enough, least), "upper_boundary": F.when(enough, F.col("q3") + upper * F.col("iqr"))}
    )


def latest_boundaries(boundaries: DataFrame) -> DataFrame:
    """The rows of the latest date of every (brand, reference_number), ties included."""
    place = F.rank().over(Window.partitionBy("brand", "reference_number").orderBy(F.col("date").desc_nulls_last()))
    return boundaries.withColumn("__place", place).where("__place = 1").drop("__place")


def filter_outliers(df: DataFrame, pre_owned: DataFrame, new: DataFrame) -> DataFrame:
    """Rows inside their bounds, ends included, or whose bounds are both null.

    Rows without a condition pass; other conditions than new and pre-owned are left out.
    """
    side = F.when(F.col("condition") == "New", "new").when(F.col("condition").isin(PRE_OWNED), "pre_owned")
    bounds = pre_owned.withColumn("__side", F.lit("pre_owned")).unionByName(new.withColumn("__side", F.lit("new")))
    bounds = bounds.select("__side", F.col("brand").alias("__b"), F.col("reference_number").alias("__r"), "lower_boundary", "upper_boundary")
    sided = df.withColumn("__s", side)
    joined = sided.join(
        bounds, (F.col("__s") == F.col("__side")) & (F.col("brand") == F.col("__b")) & (F.col("reference_number") == F.col("__r")), "left"
    )
    low, high = F.col("lower_boundary"), F.col("upper_boundary")
    kept = F.col("price").between(low, high) | (low.isNull() & high.isNull())
    return joined.where((F.col("__s").isNotNull() & kept) | is_nullish(F.col("condition"))).select(*df.columns)


def boxplot_statistics(df: DataFrame, keys: list[str], top: int) -> DataFrame:
    """Quartiles, bounds and counts by range for the ``top`` groups with most rows."""
    bounds = thresholds(with_category(group_statistics(df, keys)), by_reference=False)
    chosen = bounds.orderBy(F.desc("count"), *keys).limit(top).select(*keys, "q1", "q2", "q3", "lower_boundary", "upper_boundary")
    rows = df.join(F.broadcast(chosen), keys)
    p, low, high = F.col("price"), F.col("lower_boundary"), F.col("upper_boundary")
    ranges = {
        "below_lower": p < low, "lower_to_q1": (p >= low) & (p < F.col("q1")), "q1_to_q2": (p >= F.col("q1")) & (p < F.col("q2")),
        "q2_to_q3": (p >= F.col("q2")) & (p < F.col("q3")), "q3_to_upper": (p >= F.col("q3")) & (p <= high), "above_upper": p > high,
    }
    return rows.groupBy(*chosen.columns).agg(*[F.count_if(c).alias(n) for n, c in ranges.items()], F.count(F.lit(1)).alias("total"))
