"""Silver: keyed, enriched trips and conformed zones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart import schemas
from tripmart.functions import keys, measures
from tripmart.operators.ranking import numbered

# A vendor's pickups at one moment in one zone, in an order completed by all other
# business columns, so that only exact copies tie.
_GROUP = ("vendor_id", "pickup_datetime", "pu_location_id")
_BY_TIME = ("pickup_datetime", "pu_location_id", "vendor_id")
_ORDER = (
    "dropoff_datetime",
    "fare_amount",
    "do_location_id",
    "trip_distance",
    "tip_amount",
    "total_amount",
    "passenger_count",
    "partition_date",
)
_CODES = {"Yellow Zone": "yellow", "Boro Zone": "boro", "EWR": "ewr"}


# What a trip id is made of; `copy_number` tells rows equal in all others apart.
_ID_FIELDS = (
    "vendor_id",
    "pickup_datetime",
    "dropoff_datetime",
    "pu_location_id",
    "do_location_id",
    "fare_amount",
    "copy_number",
)


def _with_ids(ranked: DataFrame) -> DataFrame:
    fields = [F.col(c) for c in _ID_FIELDS]
    return ranked.withColumn("trip_id", keys.surrogate_key(*fields)).drop("copy_number")


def trip_ids(staged: DataFrame, *, by_time: bool = False, **ranking) -> DataFrame:
    """Staged trips with their deterministic `trip_id`.

    `by_time`, trips of one time and so of one month lie together, to be written as they are.
    """
    if by_time:
        ranking |= {"cluster_by": _BY_TIME, "in_ranges": True}
    return _with_ids(numbered(staged, _GROUP, _ORDER, "copy_number", **ranking))


def enriched(trips: DataFrame) -> DataFrame:
    """Trips with fare per mile, tip share of the total, and tip flag."""
    fare, tip = F.col("fare_amount"), F.col("tip_amount")
    return trips.withColumns(
        {
            "fare_per_mile": measures.safe_ratio(fare, F.col("trip_distance")),
            "tip_pct": measures.safe_pct(tip, F.col("total_amount")),
            "has_tip": tip > 0,
        }
    )


def trips(staged: DataFrame, **ranking) -> DataFrame:
    """Silver trips of a batch, without audit columns."""
    return enriched(trip_ids(staged, **ranking))


def monthly_batches(staged: DataFrame, *, by_time: bool = False, **ranking) -> DataFrame:
    """Silver trips as left by loading the batch's months one after another.

    Each month is numbered as if it were loaded alone.  A trip delivered again in a
    later month has the same id there and replaces the earlier row.  An id occurs
    once per month at most, so the groups of the second window stay tiny; they
    need no shuffle, as rows already lie together by the first columns of the id.
    `by_time` is that of `trip_ids`.
    """
    order = [c for c in _ORDER if c != "partition_date"]
    ranked = numbered(
        staged,
        (*_GROUP, "partition_date"),
        order,
        "copy_number",
        cluster_by=_BY_TIME if by_time else _GROUP,
        in_ranges=by_time,
        **ranking,
    )
    last = Window.partitionBy(*_ID_FIELDS).orderBy(F.desc("partition_date"))
    kept = ranked.withColumn("_nth", F.row_number().over(last)).filter(F.col("_nth") == 1)
    return enriched(_with_ids(kept.drop("_nth")))


def stamped(df: DataFrame) -> DataFrame:
    return df.withColumn("transformed_at", F.current_timestamp())


def stored(df: DataFrame) -> DataFrame:
    """Columns in the order and types of the silver table."""
    return df.select(*[F.col(f.name).cast(f.dataType) for f in schemas.SILVER_TRIPS.schema])


def service_code(service_zone: Column) -> Column:
    """Short code of a service zone; anything unlisted is `unknown`."""
    code = F.lit(None).cast("string")
    for label, short in _CODES.items():
        code = F.when(service_zone == label, short).otherwise(code)
    return F.coalesce(code, F.lit("unknown"))


def zones(staged: DataFrame, central: str = "Manhattan") -> DataFrame:
    return staged.withColumns(
        {
            "is_manhattan": F.col("borough") == central,
            "service_zone_code": service_code(F.col("service_zone")),
        }
    )
