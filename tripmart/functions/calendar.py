"""Calendar columns.

All of them work on `timestamp_ntz` wall-clock values without going through the
session time zone, so a daylight-saving gap cannot shift an hour.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripmart import schemas


def minutes_between(start: Column, end: Column) -> Column:
    """Exact decimal minutes from `start` to `end`, fractions included."""
    gap = end - start

    def part(unit: str) -> Column:
        return F.extract(F.lit(unit), gap)

    whole = part("DAY").cast("bigint") * 1440 + part("HOUR") * 60 + part("MINUTE")
    rest = part("SECOND").cast("decimal(20,13)") / F.lit(60).cast("decimal(2,0)")
    return (whole.cast("decimal(19,0)") + rest).cast(schemas.MINUTES)


def hour_start(ts: Column) -> Column:
    """`ts` cut down to its full hour."""
    return ts - F.make_dt_interval(
        F.lit(0), F.lit(0), F.minute(ts), F.extract(F.lit("SECOND"), ts)
    )


def day_of_week(ts: Column) -> Column:
    """Weekday number, Sunday = 0."""
    return F.dayofweek(ts.cast("date")) - 1


def hour_key(ts: Column) -> Column:
    """Bigint YYYYMMDDHH."""
    day = ts.cast("date")
    return (
        F.year(day).cast("bigint") * 1000000
        + F.month(day) * 10000
        + F.day(day) * 100
        + F.hour(ts)
    )


def month_text(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def time_of_day(hour: Column) -> Column:
    """Bucket of an hour number; all bounds inclusive."""
    return (
        F.when(hour.between(7, 9), "morning_peak")
        .when(hour.between(17, 19), "evening_peak")
        .when(hour.between(0, 5), "overnight")
        .otherwise("off_peak")
    )


def is_weekend(weekday: Column) -> Column:
    return F.coalesce(weekday.isin(0, 6), F.lit(False))


def padded(text: Column, width: int = 9) -> Column:
    """Blank-padded names, as the stored dimension has always held them."""
    return F.rpad(text, width, " ")
