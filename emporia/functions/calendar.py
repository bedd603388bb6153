"""Calendar attributes of the date dimension."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(d: Column) -> Column:
    """YYYYMMDD integer key, computed arithmetically (no string round trip)."""
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def week_of_year(d: Column) -> Column:
    """Week number where week 1 holds 1 January and weeks start on Sunday.

    This is not ISO ``weekofyear`` (which puts 2016-01-01 in week 53).
    Spark's ``dayofweek`` is Sunday=1, so ``dayofweek(jan1) - 1`` is the
    number of days of week 1 that fall in the previous year.
    """
    jan1 = F.trunc(d, "YEAR")
    return (F.floor((F.dayofyear(d) - 1 + F.dayofweek(jan1) - 1) / 7) + 1).cast("int")


def is_weekend(d: Column) -> Column:
    return F.when(F.dayofweek(d).isin(1, 7), 1).otherwise(0)


def month_name(d: Column) -> Column:
    return F.date_format(d, "MMMM")


def day_name(d: Column) -> Column:
    return F.date_format(d, "EEEE")
