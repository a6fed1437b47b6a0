"""Operators that work on stored tables, as queries: what is loaded, merged and kept up.

Each query stores the supplied tables in a folder of its session and returns what
lies there after the operation.  Results are read before the next query starts, by the caller.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart import schemas
from tripmart.catalog.queries import REGISTERED, _dim_zone, _silver, _staged, query
from tripmart.operators import changes, curve
from tripmart.operators.staging_area import session_folder
from tripmart.plans import gold, silver, states
from tripmart.sources import jdbc
from tripmart.store import TableStore

__all__ = ["REGISTERED"]
_FIELDS = {f.name: f for f in schemas.SILVER_TRIPS.schema}
TIPS = schemas.Table(
    "demo/tips",
    T.StructType([_FIELDS[c] for c in ("trip_id", "tip_amount", "has_tip", "partition_date")]),
    keys=("trip_id",),
    partition_by="partition_date",
    indexed=True,
)


def _store(spark) -> TableStore:
    return TableStore(spark, session_folder(spark))


def _tips(trips: DataFrame) -> DataFrame:
    return trips.select(*TIPS.schema.names)


def _stored_tips(spark, folder: str) -> TableStore:
    """All tips in a store; what a query delivers again is read from there, not made anew."""
    store = _store(spark)
    store.overwrite(TIPS, _tips(_silver(spark, folder)))
    return store


@query
def upsert_stored(spark, folder):
    """Trips of 1997 are delivered once more, two months late and with other tips, and merged.

    Their keys lie in other months than the delivery; the key index finds these.
    """
    store = _stored_tips(spark, folder)
    again = store.read(TIPS, F.year("partition_date") == 1997).withColumns(
        {
            "partition_date": F.add_months("partition_date", 2),
            "tip_amount": (F.col("tip_amount") + 1).cast(schemas.MONEY),
        }
    )
    store.upsert(TIPS, again)
    return store.read(TIPS)


@query
def key_index_lookup(spark, folder):
    """Trips of half a year, looked for by key in the months that the index names."""
    store = _stored_tips(spark, folder)
    index = store.key_index(TIPS)
    index.refresh()
    wanted = store.read(TIPS, "partition_date >= '1997-01-01' and partition_date < '1997-07-01'")
    found = index.partitions_that_may_hold(wanted, store.partitions(TIPS))
    month = F.col("partition_date")
    return (
        store.read(TIPS, month.isin(found))
        .join(wanted.select("trip_id"), "trip_id", "left_semi")
        .groupBy("partition_date")
        .agg(F.count(F.lit(1)).alias("trips"))
    )


def _reloaded(spark, folder) -> TableStore:
    """Silver with its states, of which March 1996 was then delivered again: dearer, and shorter."""
    store = _store(spark)
    # Aggregates use no column that silver adds to staged trips.
    trips = _staged(spark, folder)
    for name in set(schemas.SILVER_TRIPS.schema.names) - set(trips.columns):
        trips = trips.withColumn(name, F.lit(None))
    store.overwrite(schemas.SILVER_TRIPS, silver.stored(trips))
    for summary in _summaries(store):
        summary.refresh()
    march = dt.date(1996, 3, 1)
    again = store.read(schemas.SILVER_TRIPS, F.col("partition_date") == march)
    again = again.filter("do_location_id <= 12").withColumn(
        "total_amount", (F.col("total_amount") + 5).cast(schemas.MONEY)
    )
    store.replace_partitions(schemas.SILVER_TRIPS, again, [march])
    remade = [summary.refresh() for summary in _summaries(store)]
    if remade != [[march], [march]]:
        raise AssertionError(f"states of {remade} were made anew")
    return store


def _summaries(store: TableStore) -> list:
    return [
        states.hours_of(store, schemas.SILVER_TRIPS),
        states.destinations_of(store, schemas.SILVER_TRIPS),
    ]


@query
def hourly_metrics_kept_up(spark, folder):
    """The hourly aggregate from stored states, after one month was loaded again."""
    hours, _ = (s.read() for s in _summaries(_reloaded(spark, folder)))
    return states.hourly_metrics(hours, states.dim_date(hours), _dim_zone(spark, folder))


@query
def zone_summary_kept_up(spark, folder):
    """The zone aggregate from stored states, after one month was loaded again."""
    hours, bitmaps = (s.read() for s in _summaries(_reloaded(spark, folder)))
    return states.zone_summary(hours, bitmaps, _dim_zone(spark, folder))


@query
def yearly_destinations(spark, folder):
    """Distinct destinations per pickup zone and year, from merged bitmaps of months."""
    _, bitmaps = (s.read() for s in _summaries(_reloaded(spark, folder)))
    year = F.year("partition_date").alias("year")
    merged = states.merged_destinations(bitmaps, year)
    return states.counted(merged, _dim_zone(spark, folder), "year")


@query
def dq_unique_changed(spark, folder):
    """Keys that a delivery repeats: of its own, and of months that were there before."""
    store = _stored_tips(spark, folder)
    store.key_index(TIPS).refresh()
    verified = changes.Verified(store, TIPS)
    verified.note({})
    june = dt.date(1997, 6, 1)
    month = F.col("partition_date")
    own = store.read(TIPS, month == june)
    others = store.read(TIPS, (F.year("partition_date") == 1995) & F.col("has_tip"))
    sent = own.unionByName(own.filter("tip_amount > 3000")).unionByName(
        others.withColumn("partition_date", F.lit(june))
    )
    store.replace_partitions(TIPS, sent, [june])
    return changes.repeated_keys(store, TIPS, verified.changed())


@query
def compact_small_files(spark, folder):
    """Rows and files of months that were written in pieces and then packed."""
    store, trips = _store(spark), _tips(_silver(spark, folder))
    store.overwrite(TIPS, trips)
    pieces = trips.repartition(4).write.mode("overwrite").partitionBy("partition_date")
    pieces.parquet(store.path(TIPS))
    store.compact(TIPS)
    packed = store.read(TIPS).withColumn("file", F.col("_metadata.file_path"))
    return packed.groupBy("partition_date").agg(
        F.count(F.lit(1)).alias("trips"),
        F.sum("tip_amount").alias("tips"),
        F.countDistinct("file").alias("files"),
    )


def _ranked(df: DataFrame, table: str, key: F.Column) -> DataFrame:
    """The place at which a gold table, written as it is shown, holds each row.

    Rows that the order leaves equal share the first of their places.
    """
    path = session_folder(df.sparkSession)
    gold.shown(df, table).write.parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    lying = Window.orderBy("_metadata.file_path", "_metadata.row_index")
    equal = Window.partitionBy(*gold.SHOWN_BY[table][1:])
    placed = stored.withColumn("at", F.row_number().over(lying))
    return placed.select(
        F.lit(table).alias("table"), key.alias("key"), F.min("at").over(equal).alias("place")
    )


@query
def gold_order(spark, folder):
    """Rows of all gold tables that have an order, with their places in the written files."""
    trips, zones = _staged(spark, folder), _dim_zone(spark, folder)
    dates, measured = gold.dim_date(trips), gold.trip_measures(trips)
    text = lambda *c: F.concat_ws("|", *c)
    hourly = gold.agg_hourly_metrics(measured, dates, zones)
    by_zone = gold.agg_zone_summary(measured, zones)
    parts = [
        _ranked(dates, "dim_date", text("date_key")),
        _ranked(zones, "dim_zone", text("zone_key")),
        _ranked(
            hourly,
            "agg_hourly_metrics",
            text("date_key", "pickup_borough", "pickup_service_zone"),
        ),
        _ranked(by_zone, "agg_zone_summary", text("pickup_zone_key", "trip_month")),
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def curve_order(spark, folder):
    """Pairs of zones along the curve through both, as files laid out by it hold them."""
    pairs = _staged(spark, folder).groupBy("pu_location_id", "do_location_id")
    counted = pairs.agg(F.count(F.lit(1)).alias("trips"))
    z = curve.z_value(F.col("pu_location_id"), F.col("do_location_id"))
    place = F.row_number().over(Window.orderBy("z"))
    return counted.withColumn("z", z).withColumn("place", place)


@query
def equal_depth_splits(spark, folder):
    """Fares of all trips: how many of the conditions for a split JDBC read hold of each."""
    trips = _staged(spark, folder).select((F.col("fare_amount") * 100).cast("bigint").alias("cents"))
    trips = trips.withColumn("cents", F.nullif(F.col("cents") % 10_000, F.lit(77)))
    conditions = jdbc.equal_depth("cents", jdbc.quantile_bounds(trips, "cents", 16))
    hits = reduce(lambda a, b: a + b, [F.coalesce(F.expr(c), F.lit(False)).cast("int") for c in conditions])
    return trips.groupBy("cents", hits.alias("conditions")).agg(F.count(F.lit(1)).alias("trips"))
