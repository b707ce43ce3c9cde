"""Exact quantiles of groups of any size, without a buffer of a group's values.

Values are counted first, by (group, value), so repeats shrink before the shuffle and a hot
group is spread by its values. Every value lies in a bin, its first two digits; a group has
some hundred bins at most, whose counts tell where its ranks lie. Only the bins that hold a
wanted rank are looked into, one (group, bin) at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def bin_of(value: Column) -> Column:
    """The value cut after two digits, towards zero: never falls where the value rises."""
    size = F.abs(value)
    unit = F.pow(F.lit(10.0), F.floor(F.log10(size)) - 1)
    return F.when(value == 0, F.lit(0.0)).otherwise(F.signum(value) * F.floor(size / unit) * unit)


def weighted_quantiles(df: DataFrame, keys: list[str], value: str, wanted: dict[str, float], weight: str | None = None) -> DataFrame:
    """keys and a column for each of ``wanted`` (name: share), linear between neighbours; groups of at least one number.

    A row counts as many times as its ``weight`` says, a whole number; once without one. Nulls
    and NaN in ``value`` don't count; null keys are keys like others.
    """
    number = F.col(value).cast("double")
    own = df.where(number.isNotNull() & ~F.isnan(number))
    counts = own.groupBy(*keys, number.alias("__v")).agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("__n")).withColumn("__bin", bin_of(F.col("__v")))
    bins = counts.groupBy(*keys, "__bin").agg(F.sum("__n").alias("__in_bin"))
    before, whole = Window.partitionBy(*keys).orderBy("__bin"), Window.partitionBy(*keys)
    bins = bins.withColumns({"__upto": F.sum("__in_bin").over(before), "__all": F.sum("__in_bin").over(whole)})
    places = [(F.col("__all") - 1) * p for p in wanted.values()]
    holds = lambda start, end: [(F.floor(h) < end) & (F.ceil(h) >= start) for h in places]
    some = F.lit(False)
    for c in holds(F.col("__upto") - F.col("__in_bin"), F.col("__upto")):
        some = some | c
    bins = bins.where(some).select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col("__bin").alias("__b"), (F.col("__upto") - F.col("__in_bin")).alias("__start"), "__all")
    same = F.col("__bin") == F.col("__b")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    rows = counts.join(bins, same).drop(*[f"__k{i}" for i in range(len(keys))], "__b")
    rows = rows.withColumn("__upto", F.col("__start") + F.sum("__n").over(Window.partitionBy(*keys, "__bin").orderBy("__v")))
    at = lambda rank: F.max(F.when((F.col("__upto") - F.col("__n") <= rank) & (rank < F.col("__upto")), F.col("__v")))
    ends = [x for k, h in enumerate(places) for x in (at(F.floor(h)).alias(f"__low{k}"), at(F.ceil(h)).alias(f"__high{k}"))]
    found = rows.groupBy(*keys).agg(F.max("__all").alias("__all"), *ends)
    part = lambda h: h - F.floor(h)
    return found.select(
        *keys, *[(F.col(f"__low{k}") + (F.col(f"__high{k}") - F.col(f"__low{k}")) * part(h)).alias(name) for k, (name, h) in enumerate(zip(wanted, places, strict=True))]
    )


def with_quantiles(stats: DataFrame, df: DataFrame, keys: list[str], value: str, wanted: dict[str, float], weight: str | None = None) -> DataFrame:
    """``stats``, a row for each group, and the quantiles of its ``value`` in ``df``; null where it has none."""
    found = weighted_quantiles(df, keys, value, wanted, weight).withColumnsRenamed({k: f"__own{i}" for i, k in enumerate(keys)})
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__own{i}"))
    return stats.join(found, same, "left").drop(*[f"__own{i}" for i in range(len(keys))])
