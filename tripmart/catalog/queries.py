"""Every operator as a query over the supplied tables.

Queries run over all rows of the tables.  Decimals leave as doubles, so that
results can be compared with another engine.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart import runlog, schemas
from tripmart.functions import calendar, keys, measures
from tripmart.operators import merge, quality
from tripmart.operators.incremental import newer_than
from tripmart.operators.staging_area import session_folder
from tripmart.plans import bronze, gold, monitor, months, silver, staging
from tripmart.sources import sample
from tripmart.store import TableStore

Query = Callable[[SparkSession, str], DataFrame]
REGISTERED: dict[str, Query] = {}

# Zones that play airports, and bounds that fit the supplied amounts and dates.
AIRPORTS = (2, 7, 19)
BOUNDS = staging.StrictBounds(max_fare=60_000, max_distance=40, max_minutes=600_000)


def query(build: Query) -> Query:
    """Register a query under its function name."""

    def plain(spark: SparkSession, folder: str) -> DataFrame:
        df = build(spark, folder)
        return df.select(
            *[
                F.col(f.name).cast("double").alias(f.name)
                if isinstance(f.dataType, T.DecimalType)
                else F.col(f.name)
                for f in df.schema
            ]
        )

    REGISTERED[build.__name__] = plain
    return build


# Layers of the supplied tables


def _raw(spark: SparkSession, folder: str) -> DataFrame:
    return bronze.conform_trips(sample.trip_source(spark, folder))


def _staged(spark: SparkSession, folder: str) -> DataFrame:
    return staging.trips(_raw(spark, folder))


def _silver(spark: SparkSession, folder: str) -> DataFrame:
    rows, raw = sample.trip_rows(spark, folder), _raw(spark, folder)
    # Trips are numbered before parts of their times, which no number depends on, make them wider.
    built = staging.timed(silver.trips(staging.kept(raw), rows_at_most=rows))
    first = staging.trips(raw).columns
    return built.select(*first, *[c for c in built.columns if c not in first])


def _raw_zones(spark: SparkSession, folder: str) -> DataFrame:
    return bronze.conform_zones(sample.zone_source(spark, folder))


def _dim_zone(spark: SparkSession, folder: str) -> DataFrame:
    return gold.dim_zone(sample.zone_source(spark, folder), sample.CENTRAL_BOROUGH)


# Bronze and staging


@query
def bronze_conform(spark, folder):
    return _raw(spark, folder)


@query
def stg_trips(spark, folder):
    return _staged(spark, folder)


@query
def stg_zones(spark, folder):
    return staging.zones(_raw_zones(spark, folder))


def _stored_raw(spark: SparkSession, folder: str) -> TableStore:
    """A store of the session with all trips, partitioned by month."""
    store = TableStore(spark, session_folder(spark))
    store.overwrite(schemas.RAW_TRIPS, bronze.stamped(_raw(spark, folder)))
    return store


@query
def partition_scan(spark, folder):
    """One month of the stored table: one folder is read."""
    month = F.col("partition_date") == dt.date(1997, 3, 1)
    return _stored_raw(spark, folder).read(schemas.RAW_TRIPS, month).drop("ingested_at")


@query
def replace_partition(spark, folder):
    """Half a year of the stored table is delivered again with corrected fares."""
    store, raw = _stored_raw(spark, folder), _raw(spark, folder)
    again = [dt.date(1996, m, 1) for m in range(1, 7)]
    batch = raw.filter(F.col("partition_date").isin(again)).withColumn(
        "fare_amount", (F.col("fare_amount") + 1).cast("decimal(10,2)")
    )
    store.replace_partitions(schemas.RAW_TRIPS, bronze.stamped(batch), again)
    return store.read(schemas.RAW_TRIPS).drop("ingested_at")


@query
def backfill_outcome(spark, folder):
    """Months of which some trips are made unfit or incomplete, as a backfill screens them."""
    source = sample.trip_source(spark, folder)
    far = F.when(F.month("partition_date") == 5, F.col("trip_distance") * 1_000_000)
    open_end = F.when(
        (F.month("partition_date") != 7) | (F.col("VendorID") != 1), F.col("tpep_dropoff_datetime")
    )
    broken = source.withColumns(
        {
            "trip_distance": F.coalesce(far, F.col("trip_distance")),
            "tpep_dropoff_datetime": open_end,
        }
    )
    return bronze.outcome(bronze.screened(broken, schemas.RAW_TRIPS.not_null))


# Silver


@query
def surrogate_key(spark, folder):
    raw = _raw(spark, folder)
    passengers = F.nullif(F.col("passenger_count"), F.lit(7))
    fields = [F.col("vendor_id"), F.col("pickup_datetime"), F.col("pu_location_id"), passengers]
    return raw.select("vendor_id", "pickup_datetime", keys.surrogate_key(*fields).alias("key"))


@query
def silver_trip_id(spark, folder):
    rows = sample.trip_rows(spark, folder)
    ids = silver.trip_ids(_staged(spark, folder), rows_at_most=rows)
    return ids.select("trip_id", "vendor_id", "pickup_datetime", "dropoff_datetime")


@query
def silver_trip_id_hot(spark, folder):
    """Ids where a third of the trips share one group, numbered piecewise.

    The bound for a hot group is low, so that groups of supplied sizes take the way of the largest
    ones.
    """
    crowded = F.day("dropoff_datetime") <= 10
    year = F.trunc("partition_date", "year").cast("timestamp_ntz")
    vendor = F.when(crowded, F.lit(1)).otherwise(F.col("vendor_id")).cast("smallint")
    skewed = _staged(spark, folder).withColumns(
        {
            "vendor_id": vendor,
            "pickup_datetime": F.when(crowded, year).otherwise(F.col("pickup_datetime")),
        }
    )
    ids = silver.trip_ids(skewed, hot_rows=20)
    return ids.select("trip_id", "vendor_id", "pickup_datetime", "dropoff_datetime")


@query
def silver_enrich(spark, folder):
    trips = silver.enriched(_staged(spark, folder))
    kept = ("pickup_datetime", "fare_amount", "fare_per_mile", "tip_pct", "has_tip")
    return trips.select("vendor_id", *kept)


@query
def silver_trips(spark, folder):
    return _silver(spark, folder)


@query
def silver_zones(spark, folder):
    return silver.zones(staging.zones(_raw_zones(spark, folder)), sample.CENTRAL_BOROUGH)


@query
def silver_monthly_batches(spark, folder):
    """Trips of a year are delivered a second time one month late and move there."""
    raw = _raw(spark, folder)
    late = raw.filter(F.year("partition_date") == 1997).withColumn(
        "partition_date", F.add_months("partition_date", 1)
    )
    rows = 2 * sample.trip_rows(spark, folder)
    trips = silver.monthly_batches(staging.trips(raw.unionByName(late)), rows_at_most=rows)
    return trips.select("trip_id", "pickup_datetime", "partition_date", "fare_per_mile")


@query
def incremental_watermark(spark, folder):
    staged = _staged(spark, folder)
    loaded = staged.filter(F.col("partition_date") <= dt.date(1998, 6, 1))
    return newer_than(staged, loaded).select(
        "vendor_id", "pickup_datetime", "dropoff_datetime", "partition_date", "fare_amount"
    )


@query
def merge_upsert(spark, folder):
    """A table of the years to 1998 takes in the years from 1998 with other tips."""
    trips = _silver(spark, folder).select("trip_id", "tip_amount", "has_tip", "partition_date")
    year = F.year("partition_date")
    revised = trips.filter(year >= 1998).withColumn(
        "tip_amount", (F.col("tip_amount") + 1).cast("decimal(10,2)")
    )
    return merge.upserted(trips.filter(year <= 1998), revised, ["trip_id"])


# Gold


@query
def dim_date(spark, folder):
    return gold.dim_date(_staged(spark, folder), quarter=True)


@query
def event_hours(spark, folder):
    """The hour dimension of the event stream's timestamps."""
    events = sample.table(spark, folder, "events")
    return gold.dim_date(events.select(F.col("ts").alias("pickup_datetime")), padded=False)


@query
def dim_zone(spark, folder):
    return gold.dim_zone(sample.zone_source(spark, folder), sample.CENTRAL_BOROUGH, AIRPORTS)


@query
def dim_vendor(spark, folder):
    """The vendor dimension with the trips of each vendor; unlisted ones are unknown."""
    counted = _staged(spark, folder).groupBy("vendor_id").agg(F.count(F.lit(1)).alias("n"))
    vendors = gold.dim_vendor(spark)
    known = vendors.select("vendor_key", F.col("vendor_id").alias("vendor_text"))
    keyed = counted.join(
        known, F.col("vendor_id").cast("string") == F.col("vendor_text"), "left"
    ).groupBy(F.coalesce("vendor_key", F.lit(gold.UNKNOWN_VENDOR)).alias("vendor_key"))
    return vendors.join(keyed.agg(F.sum("n").alias("trips")), "vendor_key", "left")


@query
def role_playing_join(spark, folder):
    """Trips between boroughs: the zone dimension once as pickup, once as dropoff."""
    pairs = (
        _staged(spark, folder)
        .groupBy("pu_location_id", "do_location_id")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("total_amount").alias("amount"))
    )
    zone = _dim_zone(spark, folder)

    def role(name: str) -> DataFrame:
        return zone.select(F.col("zone_key").alias(f"{name}_key"), F.col("borough").alias(name))

    return (
        pairs.join(role("pickup"), F.col("pu_location_id") == F.col("pickup_key"), "left")
        .join(role("dropoff"), F.col("do_location_id") == F.col("dropoff_key"), "left")
        .groupBy(F.col("pickup").alias("pickup_borough"), F.col("dropoff").alias("dropoff_borough"))
        .agg(F.sum("n").alias("trips"), F.sum("amount").alias("total_revenue"))
    )


@query
def fact_trip_key(spark, folder):
    """The key is NULL where the passenger count is."""
    staged = _staged(spark, folder).withColumn(
        "passenger_count", F.nullif(F.col("passenger_count"), F.lit(7).cast("smallint"))
    )
    keyed = gold.trip_keys(staged, rows_at_most=sample.trip_rows(spark, folder))
    return keyed.select("trip_key", "pickup_datetime", "pu_location_id", "passenger_count")


@query
def fact_trips(spark, folder):
    """Facts use no column that silver adds to staged trips."""
    trips, vendors = _staged(spark, folder), gold.dim_vendor(spark)
    dates, zones = gold.dim_date(trips), _dim_zone(spark, folder)
    rows = sample.trip_rows(spark, folder)
    return gold.fact_trips(trips, dates, zones, vendors, rows_at_most=rows)


@query
def agg_hourly_metrics(spark, folder):
    trips = _staged(spark, folder)
    dates, zones = gold.dim_date(trips), _dim_zone(spark, folder)
    return gold.agg_hourly_metrics(gold.trip_measures(trips), dates, zones)


@query
def agg_zone_summary(spark, folder):
    trips = _staged(spark, folder)
    return gold.agg_zone_summary(gold.trip_measures(trips), _dim_zone(spark, folder))


@query
def zone_summary_wide(spark, folder):
    return gold.zone_summary_wide(silver.enriched(_staged(spark, folder)), AIRPORTS)


@query
def airport_flag(spark, folder):
    hit = measures.in_zones(AIRPORTS, F.col("pu_location_id"), F.col("do_location_id"))
    return (
        _staged(spark, folder)
        .groupBy("partition_date", hit.alias("is_airport_trip"))
        .agg(F.count(F.lit(1)).alias("trips"))
    )


@query
def speed_and_caps(spark, folder):
    trips = silver.enriched(_staged(spark, folder))
    speed = measures.speed_mph(F.col("trip_distance"), F.col("trip_duration_minutes"))
    return trips.select(
        "pickup_datetime",
        "dropoff_datetime",
        "trip_distance",
        speed.alias("speed_mph"),
        measures.capped(F.col("tip_pct"), 5).alias("tip_pct_capped"),
    )


# Data quality


def _report(df: DataFrame, *rules: quality.Rule, by: str = "partition_date") -> DataFrame:
    return quality.report(df, rules, by=by).select(by, "rule", "success", "failure_count")


@query
def dq_not_null(spark, folder):
    """Orders without items have NULL item columns after the join."""
    orders = sample.table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    items = sample.table(spark, folder, "lineitem").select("l_orderkey", "l_shipdate")
    joined = orders.join(items, F.col("o_orderkey") == F.col("l_orderkey"), "left").withColumn(
        "partition_date", calendar.month_start(F.col("o_orderdate").cast("date"))
    )
    return _report(joined, quality.NotNull(("o_orderdate", "l_orderkey", "l_shipdate")))


@query
def dq_between(spark, folder):
    rule = quality.Between(
        ("fare_amount", "tip_amount", "total_amount"), 1000, 100_000, mostly="0.93"
    )
    return _report(_raw(spark, folder), quality.RAW_TRIPS_AMOUNTS, rule)


@query
def dq_within_month(spark, folder):
    rule = quality.WithinMonth(columns=("dropoff_datetime",), month="partition_date", mostly="0.02")
    return _report(
        _raw(spark, folder), quality.within_partition_month("partition_date"), rule
    )


@query
def dq_min_value(spark, folder):
    return _report(
        _raw(spark, folder), quality.Between(("pu_location_id", "trip_distance"), min_value=1)
    )


@query
def dq_row_count(spark, folder):
    return _report(_raw(spark, folder), quality.RowCount(700, 800))


@query
def dq_row_rule(spark, folder):
    return _report(_raw(spark, folder), quality.NoRows("dropoff_datetime <= pickup_datetime"))


@query
def dq_not_after(spark, folder):
    rule = quality.NotAfter("dropoff_datetime", as_of=dt.datetime(1999, 6, 15, 12))
    return _report(_raw(spark, folder), rule)


@query
def dq_report(spark, folder):
    """The whole suite for raw trips, for all months in one pass."""
    raw = _raw(spark, folder)
    report = quality.report(raw, quality.raw_trips_suite("partition_date"), by="partition_date")
    return report.select("partition_date", "position", "rule", "success", "failure_count")


@query
def dq_unique(spark, folder):
    return quality.unique(_raw(spark, folder), "vendor_id", "pickup_datetime", "pu_location_id")


@query
def dq_accepted_values(spark, folder):
    events = sample.table(spark, folder, "events")
    return quality.accepted_values(events, "event_type", ["view", "click", "purchase"])


@query
def dq_relationships(spark, folder):
    """Dropoff zones that are not among the zones with a known service code."""
    zones = silver.zones(staging.zones(_raw_zones(spark, folder)))
    known = zones.filter(F.col("service_zone_code") != "unknown")
    return quality.relationships(_raw(spark, folder), "do_location_id", known, "location_id")


# Strict cleaning and monitoring


@query
def clean_strict(spark, folder):
    return staging.clean_strict(_raw(spark, folder), BOUNDS)


@query
def drop_reasons(spark, folder):
    return staging.drop_reasons(_raw(spark, folder), BOUNDS)


@query
def layer_retention(spark, folder):
    raw = _raw(spark, folder)
    strict = staging.clean_strict(raw, BOUNDS)
    return monitor.retention(raw, staging.trips(raw), strict)


@query
def month_profile(spark, folder):
    return monitor.month_profile(_staged(spark, folder))


@query
def top_pickup_zones(spark, folder):
    return monitor.top_zones(_staged(spark, folder), _raw_zones(spark, folder))


@query
def volume_drop(spark, folder):
    return monitor.volume_drop(_staged(spark, folder), percent=5)


@query
def month_spine(spark, folder):
    """All months between the first and last order, and their orders, if any."""
    orders = sample.table(spark, folder, "orders").select(
        F.col("o_orderdate").cast("date").alias("day")
    )
    bounds = orders.agg(F.min("day").alias("start"), F.max("day").alias("end"))
    counted = orders.groupBy(calendar.month_start(F.col("day")).alias("month")).agg(
        F.count(F.lit(1)).alias("n")
    )
    found = months.spine(bounds).join(counted, "month", "left")
    return found.select("month", F.coalesce("n", F.lit(0)).alias("orders"))


# Run log, with runs derived from the event stream


def _runs(events: DataFrame, status: str, path: str) -> DataFrame:
    """One run per user and event type."""
    return (
        events.groupBy(
            F.concat(F.lit("run-"), F.col("user_id")).alias("run_id"),
            F.col("event_type").alias("dag_id"),
        )
        .agg(
            F.count(F.lit(1)).alias("rows_written"),
            F.min("ts").alias("started_at"),
            F.max("ts").alias("finished_at"),
        )
        .withColumns(
            {
                "task_id": F.lit("load"),
                "status": F.lit(status),
                "partition_date": F.col("started_at").cast("date"),
                "duration_seconds": F.lit(None).cast("decimal(10,3)"),
                "delta_path": F.lit(path),
                "error_message": F.lit(None).cast("string"),
                "metadata": F.to_json(F.struct("rows_written")),
            }
        )
    )


def _events(runs: DataFrame, number: int) -> DataFrame:
    when = F.struct(F.lit(number).cast("bigint").alias("at"), F.lit("").alias("by"), F.lit(0).alias("n"))
    return runs.withColumns({"opened": when, "logged": when})


@query
def runlog_upsert(spark, folder):
    """Runs of the first half month are logged, then those of the second half; events are folded."""
    events = sample.table(spark, folder, "events")
    middle = F.lit(dt.datetime(2024, 1, 16)).cast("timestamp_ntz")
    first = _runs(events.filter(F.col("ts") < middle), "running", "first")
    later = _runs(events.filter(F.col("ts") >= middle), "success", "second")
    logged = _events(later, 2).unionByName(_events(first, 1))
    return runlog.folded(logged).drop("opened", "logged")


@query
def latest_runs(spark, folder):
    events = sample.table(spark, folder, "events")
    runs = events.select(
        F.col("event_type").alias("dag_id"),
        F.col("event_id").alias("run_id"),
        F.lit("load").alias("task_id"),
        F.col("ts").alias("started_at"),
    )
    return runlog.latest(runs, 3)
