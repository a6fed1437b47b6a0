"""Staging: row filters and derived time columns, always lazy."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart import schemas
from tripmart.functions import calendar


def plausible() -> Column:
    """Rows worth keeping; a NULL operand drops the row."""
    return (
        (F.col("trip_distance") > 0)
        & F.col("pu_location_id").isNotNull()
        & F.col("do_location_id").isNotNull()
        & (F.col("fare_amount") >= 0)
        & (F.col("total_amount") >= 0)
        & (F.col("dropoff_datetime") > F.col("pickup_datetime"))
    )


def derived() -> dict[str, Column]:
    """Duration and calendar parts of a trip, by name; they depend on its two times alone."""
    pickup, dropoff = F.col("pickup_datetime"), F.col("dropoff_datetime")
    return {
        "trip_duration_minutes": calendar.minutes_between(pickup, dropoff),
        "pickup_hour": calendar.hour_start(pickup),
        "pickup_day_of_week": calendar.day_of_week(pickup).cast("smallint"),
        "pickup_hour_of_day": F.hour(pickup).cast("smallint"),
    }


def trips(raw: DataFrame) -> DataFrame:
    """Filtered trips with duration and calendar parts."""
    return timed(kept(raw))


def timed(trips: DataFrame) -> DataFrame:
    return trips.withColumns(derived())


def kept(raw: DataFrame) -> DataFrame:
    """Filtered trips, narrow enough to be shuffled before parts are derived."""
    load_time = [c for c in ("ingested_at",) if c in raw.columns]
    return raw.filter(plausible()).select(
        "vendor_id",
        "pickup_datetime",
        "dropoff_datetime",
        "passenger_count",
        "pu_location_id",
        "do_location_id",
        "partition_date",
        *load_time,
        F.col("trip_distance").cast(schemas.DISTANCE).alias("trip_distance"),
        F.col("fare_amount").cast(schemas.MONEY).alias("fare_amount"),
        F.col("tip_amount").cast(schemas.MONEY).alias("tip_amount"),
        F.col("total_amount").cast(schemas.MONEY).alias("total_amount"),
    )


def zones(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("location_id").isNotNull())


# The stricter rules of the requirements.  The defaults are fixed values.


@dataclass(frozen=True)
class StrictBounds:
    max_fare: int = 500
    over_distance: str = "0.01"
    max_distance: int = 200
    max_minutes: int = 300


def strict_rules(bounds: StrictBounds = StrictBounds()) -> dict[str, Column]:
    """Conditions a trip must meet, by name; one with a NULL operand is not met."""
    pickup, fare, distance = F.col("pickup_datetime"), F.col("fare_amount"), F.col("trip_distance")
    minutes = calendar.minutes_between(pickup, F.col("dropoff_datetime"))
    month = calendar.month_start(F.col("partition_date"))
    rules = {
        "date_scope": calendar.month_start(pickup.cast("date")) == month,
        "fare_range": (fare > 0) & (fare <= bounds.max_fare),
        "distance_range": (distance > F.lit(bounds.over_distance).cast(schemas.DISTANCE))
        & (distance <= bounds.max_distance),
        "duration_range": (minutes > 0) & (minutes <= bounds.max_minutes),
    }
    return {name: F.coalesce(rule, F.lit(False)) for name, rule in rules.items()}


def _meets_all(rules: dict[str, Column]) -> Column:
    return reduce(lambda kept, rule: kept & rule, rules.values())


def clean_strict(raw: DataFrame, bounds: StrictBounds = StrictBounds()) -> DataFrame:
    """Rows meeting every strict rule."""
    return raw.filter(_meets_all(strict_rules(bounds)))


def drop_reasons(
    raw: DataFrame, bounds: StrictBounds = StrictBounds(), by: str = "partition_date"
) -> DataFrame:
    """Rows per month, rows kept, and rows breaking each strict rule, in one pass."""
    rules = strict_rules(bounds)
    return raw.groupBy(by).agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(_meets_all(rules)).alias("rows_kept"),
        *[F.count_if(~rule).alias(f"bad_{name}") for name, rule in rules.items()],
    )
