"""Monitoring queries over the layers and the run log."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.functions import measures


def _per_month(df: DataFrame, name: str, by: str) -> DataFrame:
    return df.groupBy(by).agg(F.count(F.lit(1)).alias(name))


def retention(
    bronze: DataFrame, silver: DataFrame, gold: DataFrame, by: str = "partition_date"
) -> DataFrame:
    """Rows per month and layer, and silver in percent of bronze.

    Each layer collapses to months before the counts meet.
    """
    counts = (
        _per_month(bronze, "bronze_rows", by)
        .join(_per_month(silver, "silver_rows", by), by, "left")
        .join(_per_month(gold, "gold_rows", by), by, "left")
        .fillna(0)
    )
    share = measures.rounded_mean(
        (F.col("silver_rows") * 100).cast("decimal(20,0)"), F.col("bronze_rows")
    )
    return counts.withColumn("silver_retention_pct", share)


def failed_months(log: DataFrame) -> DataFrame:
    """Months whose load or validation failed, with the message."""
    return (
        log.filter((F.col("status") == "failed") & F.col("partition_date").isNotNull())
        .select("partition_date", "error_message")
        .orderBy("partition_date")
    )


def month_profile(trips: DataFrame) -> DataFrame:
    """Rows, first and last pickup of each month."""
    return trips.groupBy("partition_date").agg(
        F.count(F.lit(1)).alias("trips"),
        F.min("pickup_datetime").alias("first_pickup"),
        F.max("pickup_datetime").alias("last_pickup"),
    )


def top_zones(trips: DataFrame, zones: DataFrame, n: int = 10) -> DataFrame:
    """The `n` zone names with most pickups; equal counts go by name and borough.

    Trips collapse to zone ids before the names are joined.
    """
    counted = trips.groupBy(F.col("pu_location_id").alias("location_id")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return (
        counted.join(zones.select("location_id", "zone", "borough"), "location_id")
        .groupBy(F.col("zone").alias("zone_name"), "borough")
        .agg(F.sum("n").alias("trips"))
        .orderBy(F.desc("trips"), "zone_name", "borough")
        .limit(n)
    )


def volume_drop(trips: DataFrame, percent: int = 20) -> DataFrame:
    """Months with over `percent` fewer rows than the month loaded before.

    The window sees one row per month.
    """
    before = F.lag("trips").over(Window.orderBy("partition_date"))
    return (
        _per_month(trips, "trips", "partition_date")
        .withColumn("trips_before", before)
        .filter(F.col("trips") * 100 < F.col("trips_before") * (100 - percent))
    )
