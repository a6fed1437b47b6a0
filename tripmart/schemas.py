"""Table layouts: columns, keys and partition columns of every layer."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Columns a source file must have; more are allowed.
TRIP_SOURCE_COLUMNS = (
    "VendorID",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "PULocationID",
    "DOLocationID",
    "fare_amount",
    "tip_amount",
    "total_amount",
)
ZONE_SOURCE_COLUMNS = ("LocationID", "Borough", "Zone", "service_zone")

# Numeric types of the measures.  Ratios are wide enough for the largest amount
# over the smallest distance or total.
DISTANCE = T.DecimalType(8, 2)
MONEY = T.DecimalType(10, 2)
MINUTES = T.DecimalType(36, 16)
FARE_PER_MILE = T.DecimalType(12, 2)
PERCENT = T.DecimalType(16, 2)


_TYPES = {
    "smallint": T.ShortType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "distance": DISTANCE,
    "money": MONEY,
    "minutes": MINUTES,
    "per_mile": FARE_PER_MILE,
    "percent": PERCENT,
    "seconds": T.DecimalType(10, 3),
}


def _struct(columns: str) -> T.StructType:
    """Columns given as `name type, ...`; usable before a session exists."""
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


@dataclass(frozen=True)
class Table:
    """Declared layout of one stored table; `schema=None` takes what is written.

    An indexed table keeps a key index beside it, by which merges find the partitions to look at.
    """

    name: str
    schema: T.StructType | None
    keys: tuple[str, ...] = ()
    partition_by: str | None = None
    not_null: tuple[str, ...] = ()
    indexed: bool = False


RAW_TRIPS = Table(
    "bronze/raw_trips",
    _struct(
        "vendor_id smallint, pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz,"
        " passenger_count smallint, trip_distance distance, pu_location_id smallint,"
        " do_location_id smallint, fare_amount money, tip_amount money,"
        " total_amount money, ingested_at timestamp_ntz, partition_date date"
    ),
    partition_by="partition_date",
    not_null=(
        "pickup_datetime",
        "dropoff_datetime",
        "pu_location_id",
        "do_location_id",
        "partition_date",
    ),
)
RAW_ZONES = Table(
    "bronze/raw_zones",
    _struct(
        "location_id smallint, borough string, zone string, service_zone string,"
        " ingested_at timestamp_ntz"
    ),
    keys=("location_id",),
    not_null=("location_id", "borough", "zone", "service_zone"),
)
SILVER_TRIPS = Table(
    "silver/silver_trips",
    _struct(
        "vendor_id smallint, pu_location_id smallint, do_location_id smallint,"
        " pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz,"
        " pickup_hour timestamp_ntz, pickup_day_of_week smallint, pickup_hour_of_day smallint,"
        " passenger_count smallint, trip_distance distance,"
        " trip_duration_minutes minutes, fare_amount money,"
        " tip_amount money, total_amount money, ingested_at timestamp_ntz,"
        " trip_id string, fare_per_mile per_mile, tip_pct percent, has_tip boolean,"
        " transformed_at timestamp, partition_date date"
    ),
    keys=("trip_id",),
    partition_by="partition_date",
    indexed=True,
)
SILVER_ZONES = Table("silver/silver_zones", None, keys=("location_id",))
DIM_DATE = Table("gold/dim_date", None, keys=("date_key",))
DIM_ZONE = Table("gold/dim_zone", None, keys=("zone_key",))
DIM_VENDOR = Table("gold/dim_vendor", None, keys=("vendor_key",))
FACT_TRIPS = Table(
    "gold/fact_trips",
    _struct(
        "trip_distance distance, fare_amount money, tip_amount money,"
        " total_amount money, passenger_count smallint, date_key bigint,"
        " pickup_zone_key int, dropoff_zone_key int, vendor_key int,"
        " trip_duration_min minutes, fare_per_mile per_mile,"
        " tip_pct percent, trip_key bigint, trip_month string"
    ),
    keys=("trip_key",),
    partition_by="trip_month",
)
AGG_HOURLY = Table("gold/agg_hourly_metrics", None)
AGG_ZONE = Table("gold/agg_zone_summary", None)
LAKE_TRIPS = Table(
    "lake/fact_trips",
    SILVER_TRIPS.schema,
    keys=("trip_id",),
    partition_by="partition_date",
    indexed=True,
)
LAKE_ZONES = Table("lake/dim_zones", None, keys=("location_id",))
RUN_LOG = Table(
    "log/pipeline_runs",
    _struct(
        "run_id string, dag_id string, task_id string, status string, partition_date date,"
        " rows_written bigint, duration_seconds seconds, delta_path string,"
        " error_message string, started_at timestamp, finished_at timestamp, metadata string"
    ),
    keys=("run_id", "dag_id", "task_id"),
    not_null=("run_id", "dag_id", "task_id", "status", "started_at"),
)
# Records as they were logged; when a run was first and last written orders its events.
_WHEN = T.StructType(
    [
        T.StructField("at", T.LongType()),
        T.StructField("by", T.StringType()),
        T.StructField("n", T.IntegerType()),
    ]
)
RUN_EVENTS = Table(
    "log/pipeline_run_events",
    T.StructType(
        [*RUN_LOG.schema, T.StructField("opened", _WHEN), T.StructField("logged", _WHEN)]
    ),
)
