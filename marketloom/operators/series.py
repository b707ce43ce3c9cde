"""Operators on weekly series. All share one window, (keys, date), so Spark sorts once for them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.functions import calendar
from marketloom.functions.text import floor_int
from marketloom.schema import LEVELS

# Rows that a period of so many days looks back, and its name.
LAGS = {7: (1, "1w"), 30: (5, "1m"), 90: (13, "3m"), 180: (26, "6m"), 365: (52, "1y")}
ROLLING = "rolling_avg_of_median_price"


def lag_of(days: int) -> tuple[int, str]:
    return LAGS.get(days) or (round(days / 7), f"{days}d")


def _by(keys) -> Window:
    return Window.partitionBy(*keys).orderBy("date")


def combine(history: DataFrame, week: DataFrame) -> DataFrame:
    return history.unionByName(week, allowMissingColumns=True)


def last_sunday(df: DataFrame) -> Column:
    """The Sunday nearest to the frame's last date, as a scalar subquery."""
    return df.agg(calendar.nearest_sunday(F.max("date")).alias("last")).scalar()


def forward_fill(df: DataFrame, keys, columns, when: Column | None = None) -> DataFrame:
    """Nulls of ``columns`` take the last value before them in the series, where ``when`` holds."""
    before = _by(keys).rowsBetween(Window.unboundedPreceding, 0)
    filled = {c: F.last(c, ignorenulls=True).over(before) for c in columns}
    return df.withColumns(filled if when is None else {c: F.when(when, v).otherwise(F.col(c)) for c, v in filled.items()})


def extend_and_fill(df: DataFrame, keys, columns, end: Column) -> DataFrame:
    """Series that end before ``end`` get a row for every Sunday up to it, and ``columns`` filled forward.

    Other series stay as they are. New rows hold the keys, the date and what is filled.
    """
    whole = Window.partitionBy(*keys)
    marked = df.withColumn("__last", F.max("date").over(whole))
    short = (F.col("__last") < end) & F.col("__last").isNotNull()
    added = F.when(short & (F.col("date") == F.col("__last")), calendar.sundays_between(F.col("__last"), end))
    days = F.concat(F.array(F.col("date")), F.coalesce(added, F.array().cast("array<date>")))
    rows = marked.withColumn("__day", F.explode_outer(days))
    new = ~F.col("__day").eqNullSafe(F.col("date"))
    kept = {c: F.when(~new, F.col(c)) for c in df.columns if c not in (*keys, "date")}
    rows = rows.withColumns(kept).withColumn("date", F.col("__day"))
    return forward_fill(rows, keys, columns, short).select(*df.columns)


def rolling_average(df: DataFrame, keys, quantize: bool = False, decimals: int | None = None) -> DataFrame:
    """Mean of the median price over up to five rows, written only after the series' last row that has one."""
    w = _by(keys)
    place = F.row_number().over(w)
    marked = df.withColumn("__place", place)
    filled = F.max(F.when(F.col(ROLLING).isNotNull(), F.col("__place"))).over(Window.partitionBy(*keys))
    mean = F.avg("median_price").over(w.rowsBetween(-4, 0))
    mean = mean if decimals is None else F.round(mean, decimals)
    due = F.col("__place") > F.coalesce(filled, F.lit(0))
    out = marked.withColumn(ROLLING, F.when(due, mean).otherwise(F.col(ROLLING))).drop("__place")
    return out.withColumn(ROLLING, floor_int(F.col(ROLLING))) if quantize else out


def changes(df: DataFrame, keys, current: Column, offsets=tuple(LAGS), decimals: int | None = None) -> DataFrame:
    """Percentage and amount of change over each offset, on the rows of the date ``current``; null elsewhere.

    A lag of 0 gives no percentage, a series with too few rows neither.
    """
    w, now = _by(keys), F.col(ROLLING)
    found = {}
    rounded = (lambda c: c) if decimals is None else (lambda c: F.round(c, decimals))
    for days in offsets:
        k, name = lag_of(days)
        then = F.lag(ROLLING, k).over(w)
        here = F.col("date") == current
        found[f"pct_change_{name}"] = F.when(here & (then != 0), rounded((now - then) / then * 100))
        found[f"dol_change_{name}"] = F.when(here, rounded(now - then))
    return df.withColumns(found)


def current_week(df: DataFrame, current: Column) -> DataFrame:
    return df.where(F.col("date") == current)


def price_history(history: DataFrame, week: DataFrame, level: str, quantize: bool = True) -> DataFrame:
    """This week's rows of a level: history and week combined, extended, averaged and compared."""
    lv = LEVELS[level]
    both = combine(history, week)
    end = last_sunday(both)
    both = both if ROLLING in both.columns else both.withColumn(ROLLING, F.lit(None).cast("double"))
    filled = extend_and_fill(both, lv.keys, [c for c in lv.carried if c in both.columns], end)
    return current_week(changes(rolling_average(filled, lv.keys, quantize), lv.keys, end), end)


def week_on_week(df: DataFrame, keys, values) -> DataFrame:
    """Difference and percentage change to the row before; the percentage fills nulls forward first."""
    w = _by(keys)
    out = {}
    for c in values:
        padded = F.last(c, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
        before = F.last(c, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
        out[f"{c}_$_change"] = F.col(c) - F.lag(c).over(w)
        out[f"{c}_%_change"] = F.try_divide(padded - before, before) * 100
    return df.withColumns(out)


def recent_dates(df: DataFrame, n: int, column: str = "date") -> DataFrame:
    """Rows of the ``n`` latest distinct dates."""
    latest = df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(F.desc(column)).limit(n)
    return df.join(F.broadcast(latest), column, "left_semi")
