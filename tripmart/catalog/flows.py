"""The whole job as queries: supplied tables delivered as monthly files and loaded through all layers.

All years' trips are moved into one, so that there are twelve files, of which one is spoilt.  The load is made once per session and folder; queries read what it has left in its tables.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart import schemas
from tripmart.catalog.queries import query
from tripmart.catalog.stored import REGISTERED
from tripmart.operators import quality
from tripmart.operators.publishing import Files
from tripmart.operators.staging_area import session_folder
from tripmart.plans import monitor
from tripmart.plans.flow import Flow
from tripmart.sources import files, sample
from tripmart.store import TableStore

__all__ = ["REGISTERED"]

# Boroughs that the regions of the supplied tables stand for.
BOROUGHS = {
    "AFRICA": "Bronx",
    "AMERICA": "Brooklyn",
    "ASIA": "Manhattan",
    "EUROPE": "Queens",
    "MIDDLE EAST": "EWR",
}
YEAR = 1995
# The month whose file lacks some dropoff zones.
SPOILT = dt.date(YEAR, 7, 1)
_loads: dict[tuple[str, str], Flow] = {}


def _delivered(spark, folder: str, root: str) -> list[dt.date]:
    """Write a file per month, and the zone file; the months."""
    trips = sample.trip_source(spark, folder)
    back = F.make_ym_interval(F.year("partition_date") - YEAR, F.lit(0))
    for column in ("tpep_pickup_datetime", "tpep_dropoff_datetime"):
        trips = trips.withColumn(column, F.col(column) - back)
    day = F.col("tpep_pickup_datetime").cast("date")
    lost = (F.trunc(day, "month") == F.lit(SPOILT)) & (F.col("VendorID") == 3)
    named = trips.drop("partition_date").withColumns(
        {
            "DOLocationID": F.when(~lost, F.col("DOLocationID")),
            "month": F.date_format(F.trunc(day, "month"), "yyyy-MM-dd"),
        }
    )
    together = named.hint("rebalance", "month").write.option("compression", "zstd")
    together.partitionBy("month").parquet(f"{root}/drop")
    system, months = Files(spark), []
    system.make_folder(f"{root}/files")
    for name in system.names(f"{root}/drop"):
        if name.startswith("month="):
            months.append(dt.date.fromisoformat(name.removeprefix("month=")))
            system.rename(f"{root}/drop/{name}", files.trip_path(f"{root}/files", months[-1]))
    boroughs = F.create_map(*[F.lit(x) for pair in BOROUGHS.items() for x in pair])
    zones = sample.zone_source(spark, folder).withColumn("Borough", boroughs[F.col("Borough")])
    zones.coalesce(1).write.option("header", True).csv(f"{root}/zones.csv")
    return sorted(months)


def _suite(month) -> tuple[quality.Rule, ...]:
    """Rules that the supplied amounts can keep: these are larger than taxi fares."""
    return quality.RAW_TRIPS_NOT_NULL, quality.within_partition_month(month)


def _loaded(spark, folder: str) -> Flow:
    key = (spark.sparkContext.applicationId, folder)
    if key not in _loads:
        root = session_folder(spark)
        months = _delivered(spark, folder, root)
        flow = Flow(
            TableStore(spark, f"{root}/store"),
            f"{root}/files",
            f"{root}/zones.csv",
            trips_suite=_suite,
        )
        flow.backfill(months[0], months[-1])
        _loads[key] = flow
    return _loads[key]


@query
def flow_raw_trips(spark, folder):
    """Raw trips as read from their files and loaded by month."""
    flow = _loaded(spark, folder)
    return flow.store.read(schemas.RAW_TRIPS).drop("ingested_at")


@query
def flow_silver_trips(spark, folder):
    """Silver as merged from the loaded months."""
    silver = _loaded(spark, folder).store.read(schemas.SILVER_TRIPS)
    return silver.drop("ingested_at", "transformed_at")


@query
def flow_lake_trips(spark, folder):
    """Trips published to the lake, summed up by month."""
    lake = _loaded(spark, folder).store.read(schemas.LAKE_TRIPS)
    return lake.groupBy("partition_date").agg(
        F.count(F.lit(1)).alias("trips"),
        F.countDistinct("trip_id").alias("ids"),
        F.sum("total_amount").alias("total_amount"),
    )


@query
def flow_lake_zones(spark, folder):
    """Zones from the zone file, as published."""
    return _loaded(spark, folder).store.read(schemas.LAKE_ZONES).drop("ingested_at", "transformed_at")


@query
def flow_fact_trips(spark, folder):
    return _loaded(spark, folder).store.read(schemas.FACT_TRIPS)


@query
def flow_agg_hourly(spark, folder):
    return _loaded(spark, folder).store.read(schemas.AGG_HOURLY)


@query
def flow_agg_zone(spark, folder):
    return _loaded(spark, folder).store.read(schemas.AGG_ZONE)


@query
def flow_failed_months(spark, folder):
    """Months that the backfill left out, and why."""
    return monitor.failed_months(_loaded(spark, folder).log.read())


@query
def flow_months_loaded(spark, folder):
    """Months that the run log holds as loaded, with the trips they brought to silver."""
    flow = _loaded(spark, folder)
    done = flow.log.read().filter("task_id = 'load_month' and status = 'success'")
    trips = flow.store.read(schemas.SILVER_TRIPS).groupBy("partition_date").count()
    return done.select("partition_date", "status").join(trips, "partition_date", "left").select(
        "partition_date", "status", F.col("count").alias("trips")
    )


@query
def flow_task_states(spark, folder):
    """What the run log says of each task of the load; gold's rows are those of several tables."""
    log: DataFrame = _loaded(spark, folder).log.read()
    rows = F.when(~F.col("task_id").isin("build_gold", "load_month"), F.col("rows_written"))
    return log.groupBy("dag_id", "task_id", "status").agg(
        F.count(F.lit(1)).alias("runs"), F.sum(rows).alias("rows")
    )


@query
def flow_gate(spark, folder):
    """Per month: whether the gate lets raw trips through, with a rule of one's own added."""
    raw = _loaded(spark, folder).store.read(schemas.RAW_TRIPS)
    own = quality.NoRows("trip_distance < 1 and total_amount > 50000", name="short_and_dear")
    rules = (*quality.raw_trips_suite("partition_date"), own)
    rows = quality.report(raw, rules, by="partition_date")
    return quality.gate(rows, "partition_date")
