"""Weekly calendar and period bins as Column functions; a week is named by its Sunday."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def nearest_sunday(d: Column) -> Column:
    """Sunday itself; Monday to Wednesday the one before, Thursday to Saturday the one after."""
    return F.next_day(F.date_sub(d, 4), "SU")


def prior_sunday(d: Column) -> Column:
    """The last Sunday before the day."""
    return F.next_day(F.date_sub(d, 8), "SU")


def folder_sunday(d: Column) -> Column:
    """Sunday itself, else the one before."""
    return F.next_day(F.date_sub(d, 7), "SU")


def week_end(d: Column) -> Column:
    """The Sunday that ends the week (Sunday, Sunday] of a day."""
    return F.next_day(F.date_sub(d, 1), "SU")


def sundays_between(after: Column, last: Column) -> Column:
    """All Sundays in (after, last]; empty if there is none."""
    first = F.next_day(after, "SU")
    days = F.sequence(first, last, F.expr("INTERVAL 7 DAYS"))
    return F.when(first <= last, days).otherwise(F.array().cast("array<date>"))


def ingest_days(d: Column) -> Column:
    """Days from the Thursday before up to a day from Sunday to Wednesday; null on other days."""
    back = F.pmod(F.dayofweek(d) - 5, F.lit(7))
    return F.when(F.dayofweek(d).between(1, 4), F.sequence(F.date_sub(d, back), d, F.expr("INTERVAL 1 DAY")))


def years_ago(d: Column, years: float) -> Column:
    return F.date_sub(d, int(years * 365.25))


def even_iso_week(d: Column) -> Column:
    return F.weekofyear(d) % 2 == 0


def month_end(d: Column) -> Column:
    return F.last_day(d)


def quarter_end(d: Column) -> Column:
    return F.last_day(F.add_months(F.trunc(d, "QUARTER"), 2))


def year_end(d: Column) -> Column:
    return F.make_date(F.year(d), F.lit(12), F.lit(31))


def quarter_index(d: Column) -> Column:
    return F.year(d) * 4 + F.quarter(d) - 1


def two_quarter_index(d: Column, first: Column) -> Column:
    """0 for the quarter of ``first``, then 1, 2 ... for each pair of quarters after it."""
    return F.ceil((quarter_index(d) - quarter_index(first)) / 2).cast("int")


def two_quarter_end(d: Column, first: Column) -> Column:
    q = quarter_index(first) + two_quarter_index(d, first) * 2
    return F.last_day(F.make_date(F.floor(q / 4).cast("int"), (q % 4 * 3 + 3).cast("int"), F.lit(1)))
