"""Bronze: source columns to typed rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart import schemas

# Bronze name, source name and type of every trip column.
_TRIP_COLUMNS = (
    ("vendor_id", "VendorID", "smallint"),
    ("pickup_datetime", "tpep_pickup_datetime", "timestamp_ntz"),
    ("dropoff_datetime", "tpep_dropoff_datetime", "timestamp_ntz"),
    ("passenger_count", "passenger_count", "smallint"),
    ("trip_distance", "trip_distance", "decimal(8,2)"),
    ("pu_location_id", "PULocationID", "smallint"),
    ("do_location_id", "DOLocationID", "smallint"),
    ("fare_amount", "fare_amount", "decimal(10,2)"),
    ("tip_amount", "tip_amount", "decimal(10,2)"),
    ("total_amount", "total_amount", "decimal(10,2)"),
    ("partition_date", "partition_date", "date"),
)
_ZONE_COLUMNS = (
    ("location_id", "LocationID", "smallint"),
    ("borough", "Borough", "string"),
    ("zone", "Zone", "string"),
    ("service_zone", "service_zone", "string"),
)


def _typed(columns: Sequence[tuple[str, str, str]]) -> list[Column]:
    return [F.col(source).cast(kind).alias(name) for name, source, kind in columns]


def conform_trips(source: DataFrame) -> DataFrame:
    """Typed trips.  A value that does not fit its type stops the load (ANSI casts)."""
    return source.select(*_typed(_TRIP_COLUMNS))


def screened(source: DataFrame, required: Sequence[str]) -> DataFrame:
    """Typed trips with flags instead of errors.

    `unfit`: some value does not fit its type (and is NULL here).  `missing`: some
    required column is NULL in the source.
    """
    unfit = missing = F.lit(False)
    for name, column, kind in _TRIP_COLUMNS:
        value = F.col(column)
        unfit = unfit | (value.isNotNull() & value.try_cast(kind).isNull())
        if name in required:
            missing = missing | value.isNull()
    typed = [F.col(column).try_cast(kind).alias(name) for name, column, kind in _TRIP_COLUMNS]
    return source.select(*typed, unfit.alias("unfit"), missing.alias("missing"))


def outcome(trips: DataFrame) -> DataFrame:
    """Rows, unfit rows and rows with missing values per month of screened trips."""
    return trips.groupBy("partition_date").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if("unfit").alias("unfit"),
        F.count_if("missing").alias("missing"),
    )


def conform_zones(source: DataFrame) -> DataFrame:
    return source.select(*_typed(_ZONE_COLUMNS))


def stamped(df: DataFrame) -> DataFrame:
    """With the time of the load, one value for the whole batch."""
    return df.withColumn("ingested_at", F.localtimestamp())


def enforce(df: DataFrame, table: schemas.Table) -> DataFrame:
    """`df` whose use fails on a NULL in a required column.

    The check rides along with the write, so it costs no pass of its own, and a
    failing task keeps the whole load from being published.
    """
    checked = {
        c: F.when(
            F.col(c).isNull(), F.raise_error(F.lit(f"{table.name}.{c} must not be NULL"))
        ).otherwise(F.col(c))
        for c in table.not_null
    }
    return df.withColumns(checked)
