"""Guarded ratios and exact averages on decimals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripmart import schemas


def safe_ratio(amount: Column, per: Column) -> Column:
    """`amount / per` to two digits (half away from zero); NULL unless per > 0."""
    return F.when(per > 0, F.round(amount / per, 2)).cast(schemas.FARE_PER_MILE)


def safe_pct(part: Column, whole: Column) -> Column:
    """`part` in percent of `whole`; 0 unless whole > 0.

    Multiplying first keeps the quotient's rounding error below the distance of
    any non-tie to a tie.
    """
    pct = F.round(part * F.lit(100).cast("decimal(3,0)") / whole, 2)
    return F.when(whole > 0, pct).otherwise(F.lit(0)).cast(schemas.PERCENT)


def rounded_mean(total: Column, count: Column, scale: int = 2) -> Column:
    """Mean from a decimal sum of the given scale, to two digits, half away from zero.

    `avg` on decimals keeps too few digits to be rounded afterwards.  Here the
    quotient has twelve or more, which decides every tie up to 10**10 values.  An
    empty group has no mean.
    """
    wide = total.cast("decimal(28,2)" if scale == 2 else "decimal(32,10)")
    return F.round(F.try_divide(wide, count), 2).cast("decimal(22,2)")


def speed_mph(distance: Column, minutes: Column) -> Column:
    """Miles per hour to two digits; NULL unless minutes > 0."""
    return F.when(
        minutes > 0,
        F.round(
            (distance * 60).cast("decimal(20,2)") / minutes.cast("decimal(18,8)"), 2
        ).cast("decimal(20,2)"),
    )


def capped(value: Column, cap: float | int) -> Column:
    """`value`, at most `cap`; NULL stays NULL."""
    return F.when(value > F.lit(cap), F.lit(cap)).otherwise(value)


def in_zones(zones: Sequence[int], *columns: Column) -> Column:
    """Whether any of the zone columns is one of `zones`; NULL zones do not count."""
    hit = F.lit(False)
    for column in columns:
        hit = hit | F.coalesce(column.isin(list(zones)), F.lit(False))
    return hit
