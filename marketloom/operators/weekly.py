"""Weekly aggregation of listings at any level."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.functions.calendar import week_end
from marketloom.functions.text import identifier, slug
from marketloom.operators.quantiles import with_quantiles
from marketloom.operators.series import recent_dates, week_on_week
from marketloom.schema import LEVELS, PRE_OWNED, Level


def first_non_null(c: str, order: str) -> Column:
    """The value of the first row, by ``order``, where neither is null; of rows alike in ``order`` the smallest value."""
    own = F.struct(F.col(order).alias("order"), F.col(c).alias("value"))
    return F.min(F.when(F.col(c).isNotNull() & F.col(order).isNotNull(), own))["value"]


def joined_values(c: str) -> Column:
    """Distinct values, sorted and joined."""
    return F.array_join(F.array_sort(F.collect_set(c)), ", ")


def weekly(df: DataFrame, level: str | Level, order: str = "hash_id", hot: bool | None = None) -> DataFrame:
    """One row for each key of the level and date: prices, count, sources and what the level carries.

    Null keys make no row. Firsts are by ``order``; the mean is not rounded here. The medians of
    ``hot`` keys, which may hold a large part of all rows (by default whole brands), are taken
    from counts of prices, others from the prices of the key.
    """
    level = LEVELS[level] if isinstance(level, str) else level
    hot = len(level.keys) == 1 if hot is None else hot
    counted = F.count("reference_number") if "reference_number" in level.keys else F.count(F.lit(1))
    own, group = df.dropna(subset=list(level.keys)), [*level.keys, "date"]
    out = own.groupBy(*group).agg(
        *[first_non_null(c, order).alias(c) for c in (*level.firsts, "currency")],
        *([] if hot else [F.median("price").alias("median_price")]), F.avg("price").alias("mean_price"),
        F.max("price").alias("high"), F.min("price").alias("low"),
        counted.alias("count"), joined_values("source").alias("source"),
    )
    if hot:
        out = with_quantiles(out, own, group, "price", {"median_price": 0.5})
    out = out.withColumns({"condition": F.lit("Mixed"), "brand_slug": slug(F.col("brand"))})
    return out.withColumn("identifier", identifier(F.col("brand_slug"), F.col(level.keys[-1]))) if len(level.keys) > 1 else out


def active_listings(df: DataFrame, keys: list[str], condition: str | None = None, order: str = "hash_id") -> DataFrame:
    """Prices by key and week (Sunday, Sunday], of one condition or all, with changes to the key's week before; latest week only."""
    own = df if condition is None else df.where(F.col("condition") == condition)
    weeks = own.dropna(subset=keys).withColumn("date", week_end(F.col("date"))).groupBy(*keys, "date").agg(
        first_non_null("currency", order).alias("currency"), F.median("price").alias("median_price"), F.avg("price").alias("mean_price"),
        F.max("price").alias("high"), F.min("price").alias("low"), F.count("price").alias("count"),
    )
    return recent_dates(week_on_week(weeks, keys, ["median_price", "mean_price", "count"]), 1)


def market_makeup(df: DataFrame, keys: list[str], scope: list[str] | None = None) -> DataFrame:
    """Counts and shares of new and pre-owned listings by (keys, date); popularity relative to the largest group of ``scope``.

    Shares are null where there is neither. The popularity of a scope without listings is null.
    """
    group = [*keys, "date"]
    out = df.dropna(subset=group).groupBy(*group).agg(
        F.count_if(F.col("condition") == "New").alias("numb_of_new_listings"),
        F.count_if(F.col("condition").isin(PRE_OWNED)).alias("numb_of_pre_owned_listings"),
    )
    total = F.col("numb_of_new_listings") + F.col("numb_of_pre_owned_listings")
    out = out.withColumn("numb_of_total_listings", total)
    # The largest total is an aggregate of the groups, brought back, so that no task holds a whole scope.
    if scope:
        joined = out.join(out.groupBy(*scope).agg(F.max("numb_of_total_listings").alias("__most")), scope)
    else:
        joined = out.withColumn("__most", out.agg(F.max("numb_of_total_listings")).scalar())
    share = lambda c, of: F.try_divide(F.col(c), F.col(of)) * 100
    return joined.withColumns(
        {
            "pct_new": share("numb_of_new_listings", "numb_of_total_listings"),
            "pct_pre_owned": share("numb_of_pre_owned_listings", "numb_of_total_listings"),
            "listings_popularity_score": share("numb_of_total_listings", "__most"),
        }
    ).drop("__most")


def makeup_at_all_levels(df: DataFrame) -> DataFrame:
    """Counts of all four levels in one pass over the listings, with a ``level`` column."""
    sets = [[F.col(k) for k in (*level.keys, "date")] for level in LEVELS.values()]
    keys = ["brand", "reference_number", "specific_model", "parent_model", "date"]
    # Nulls of a set's own key make no group; grouping_id tells a null key from one that is not in the set.
    named = df.groupingSets(sets, *keys).agg(
        F.grouping_id().alias("g"),
        F.count_if(F.col("condition") == "New").alias("numb_of_new_listings"),
        F.count_if(F.col("condition").isin(PRE_OWNED)).alias("numb_of_pre_owned_listings"),
    )
    level, whole = F.lit(None), F.lit(False)
    for name, lv in LEVELS.items():
        bits = sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in (*lv.keys, "date"))
        level = F.when(F.col("g") == bits, name).otherwise(level)
        full = F.col("date").isNotNull()
        for k in lv.keys:
            full = full & F.col(k).isNotNull()
        whole = F.when(F.col("g") == bits, full).otherwise(whole)
    return named.where(whole).withColumn("level", level).drop("g")
