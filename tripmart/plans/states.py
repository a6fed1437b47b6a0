"""Partial results per month of silver trips, from which gold's aggregates are put together.

A month's states are made from that month alone.  They are sums, counts and sets, so that
states of any months can be merged; a month that is loaded again has its states replaced.
Destinations are bitmaps, which merge exactly where distinct counts cannot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart import schemas
from tripmart.functions import calendar
from tripmart.operators.summaries import Summary
from tripmart.plans import gold

MONTH = "partition_date"


def hours(trips: DataFrame) -> DataFrame:
    """Sums per month, pickup hour and pickup zone."""
    hour = calendar.hour_start(F.col("pickup_datetime"))
    measured = gold.trip_measures(trips.withColumn("hour", hour), "hour", MONTH)
    return gold.hourly_sums(measured, MONTH, "hour")


def destinations(trips: DataFrame) -> DataFrame:
    """Bitmaps of dropoff zones per month and pickup zone; an absent zone is the unknown one.

    Pairs collapse to one row each before bitmaps are made of them.
    """
    pairs = trips.select(
        MONTH,
        F.col("pu_location_id").alias("pickup_zone_key"),
        F.coalesce("do_location_id", F.lit(gold.UNKNOWN_KEY)).alias("zone"),
    ).distinct()
    return pairs.groupBy(MONTH, "pickup_zone_key", _bucket("zone")).agg(_bits("zone"))


def _bucket(column: str) -> Column:
    return F.bitmap_bucket_number(F.col(column)).alias("bucket")


def _bits(column: str) -> Column:
    return F.bitmap_construct_agg(F.bitmap_bit_position(F.col(column))).alias("bits")


def merged_destinations(states: DataFrame, *by: str | Column) -> DataFrame:
    """Bitmaps of all months together, per pickup zone and `by`."""
    return states.groupBy("pickup_zone_key", *by, "bucket").agg(
        F.bitmap_or_agg("bits").alias("bits")
    )


def counted(merged: DataFrame, zones: DataFrame, *by: str) -> DataFrame:
    """unique_destinations per pickup zone and `by`; all zones that `zones` lacks count as one."""
    known = zones.select(F.col("zone_key").alias("zone")).groupBy(_bucket("zone"))
    known = known.agg(_bits("zone").alias("known"))
    key = ["pickup_zone_key", *by, "bucket"]
    both = merged.join(known, "bucket", "left").select(
        *key,
        F.bitmap_count("bits").alias("n"),
        F.explode(F.array("bits", F.coalesce("known", F.repeat(F.lit("\0"), 4096).cast("binary")))).alias("side"),
    )
    per_bucket = both.groupBy(*key).agg(
        F.max("n").alias("n"), F.bitmap_count(F.bitmap_and_agg("side")).alias("of_known")
    )
    some_unknown = (F.sum("n") > F.sum("of_known")).cast("bigint")
    return per_bucket.groupBy("pickup_zone_key", *by).agg(
        (F.sum("of_known") + some_unknown).alias("unique_destinations")
    )


def hours_of(store, table: schemas.Table) -> Summary:
    return _summary(store, table, "hours", hours)


def destinations_of(store, table: schemas.Table) -> Summary:
    return _summary(store, table, "destinations", destinations)


def _summary(store, table: schemas.Table, name: str, build) -> Summary:
    none = store.spark.createDataFrame([], table.schema)
    return Summary(store, table, name, build(none).schema, build)


def hourly_metrics(states: DataFrame, dates: DataFrame, zones: DataFrame) -> DataFrame:
    sums = states.withColumn("date_key", calendar.hour_key(F.col("hour")))
    return gold.hourly_metrics(sums, dates, zones)


def zone_summary(sums: DataFrame, bitmaps: DataFrame, zones: DataFrame) -> DataFrame:
    month = calendar.month_text(F.col(MONTH)).alias("trip_month")
    unique = counted(merged_destinations(bitmaps, month), zones, "trip_month")
    return gold.zone_summary(sums.withColumn("trip_month", month), unique, zones)


def dim_date(states: DataFrame) -> DataFrame:
    return gold.dim_date(states.select(F.col("hour").alias("pickup_datetime")))


def months_with_zones(
    sums: DataFrame, bitmaps: DataFrame, zone_ids: list[int]
) -> DataFrame:
    """Months with trips from or to one of these zones; no trip is read."""
    at = sums.filter(F.col("pickup_zone_key").isin(zone_ids)).select(MONTH)
    # A bitmap that keeps all its bits when those of a zone are added holds the zone.
    wanted = sums.sparkSession.createDataFrame([(z,) for z in zone_ids], "zone int")
    marks = wanted.groupBy("zone", _bucket("zone")).agg(_bits("zone").alias("mark"))
    joined = bitmaps.join(F.broadcast(marks), "bucket").select(
        MONTH,
        "pickup_zone_key",
        "bucket",
        "zone",
        F.bitmap_count("bits").alias("n"),
        F.explode(F.array("bits", "mark")).alias("side"),
    )
    with_mark = joined.groupBy(MONTH, "pickup_zone_key", "bucket", "zone", "n").agg(
        F.bitmap_count(F.bitmap_or_agg("side")).alias("both")
    )
    to = with_mark.filter(F.col("both") == F.col("n")).select(MONTH)
    return at.unionByName(to).distinct()
