"""Aggregate measures shared by the report views."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SUM_MONEY = "decimal(38,2)"
AVG_MONEY = "decimal(18,6)"
_WIDE = "decimal(38,0)"


def count_when(cond: Column) -> Column:
    """SUM(CASE WHEN cond THEN 1 ELSE 0 END) as bigint (NULL conditions do not count)."""
    return F.count_if(cond).cast("long")


def sum_money(c: str | Column) -> Column:
    return F.sum(c).cast(SUM_MONEY)


def avg_money(c: str | Column) -> Column:
    """Exact decimal average (sum / count in decimals, half-up at 6 places)."""
    return F.avg(c).cast(AVG_MONEY)


def int_div(a: Column, b: Column) -> Column:
    """Exact floor division of non-negative longs (no double round trip)."""
    r = a % b
    return ((a - r).cast(_WIDE) / b.cast(_WIDE)).cast(_WIDE)


def rate_pct(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator * 100 as DECIMAL(5,2), rounded half-up, in integers.

    NULL when the denominator is 0; NULL (not an error) above 999.99.
    The numerator is not bounded by the denominator, so > 100 is possible.
    """
    n = numerator.cast("decimal(20,0)")  # wide enough for any long times 20000
    d = denominator.cast("decimal(20,0)")
    hundredths = int_div(n * 20000 + d, d * 2)
    return F.when(d != 0, (hundredths / 100).try_cast("decimal(5,2)"))
