"""Values of every layer on small fixtures, including the borders of each rule."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tripmart.catalog.queries import BOUNDS
from tripmart.functions import calendar, keys, measures
from tripmart.plans import bronze, gold, monitor, silver, staging
from tripmart.sources import files

from tests.conftest import JANUARY


@pytest.fixture
def two_trips(spark, trip_csv):
    return bronze.conform_trips(files.read_trips(spark, trip_csv, JANUARY))


@pytest.fixture
def zone_seed(spark, zone_csv):
    return files.read_zone_seed(spark, zone_csv)


def _star(spark, staged, seed, **options):
    dates, zones = gold.dim_date(staged), gold.dim_zone(seed)
    fact = gold.fact_trips(staged, dates, zones, gold.dim_vendor(spark), **options)
    return fact, dates, zones


def test_two_trips_through_silver(two_trips):
    rows = silver.trips(staging.trips(two_trips)).orderBy("vendor_id").collect()
    assert [r.trip_duration_minutes for r in rows] == [20, 35]
    assert [r.fare_per_mile for r in rows] == [Decimal("4.14"), Decimal("3.41")]
    assert [r.tip_pct for r in rows] == [Decimal("12.12"), Decimal("15.15")]
    assert [r.has_tip for r in rows] == [True, True]
    assert [r.pickup_day_of_week for r in rows] == [1, 1]
    assert [r.pickup_hour for r in rows] == [
        dt.datetime(2024, 1, 15, 8),
        dt.datetime(2024, 1, 15, 9),
    ]
    assert len({r.trip_id for r in rows}) == 2


def test_two_trips_through_gold(spark, two_trips, zone_seed):
    fact, dates, zones = _star(spark, staging.trips(two_trips), zone_seed)
    rows = fact.orderBy("date_key").collect()
    assert [r.date_key for r in rows] == [2024011508, 2024011509]
    assert [r.tip_pct for r in rows] == [Decimal("13.79"), Decimal("17.86")]
    assert [r.vendor_key for r in rows] == [1, 2]
    assert [r.trip_month for r in rows] == ["2024-01"] * 2
    day = dates.orderBy("date_key").first()
    assert day.trip_month_name == "January  " and day.day_of_week == "Monday   "
    assert day.time_of_day_bucket == "morning_peak" and not day.is_weekend
    summary = gold.agg_zone_summary(fact, zones).orderBy("pickup_zone_key").collect()
    assert [(r.pickup_zone_key, r.trip_count, r.unique_destinations) for r in summary] == [
        (100, 1, 1),
        (150, 1, 1),
    ]


def test_unknown_members(spark, raw_trip, zone_seed):
    staged = staging.trips(
        raw_trip(
            dict(vendor_id=6, do_location_id=999),
            dict(vendor_id=None, pu_location_id=998, pickup_datetime="2024-01-15 08:01:00"),
            dict(vendor_id=2, fare_amount="0", total_amount="0", tip_amount=None),
        )
    )
    fact, dates, zones = _star(spark, staged, zone_seed)
    by_pickup = {(r.pickup_zone_key, r.dropoff_zone_key, r.vendor_key): r for r in fact.collect()}
    assert set(by_pickup) == {(100, -1, 0), (-1, 200, 0), (100, 200, 2)}
    free = by_pickup[(100, 200, 2)]
    assert free.tip_pct == 0 and free.fare_per_mile == 0 and free.trip_key is None
    zone = gold.agg_zone_summary(fact, zones).collect()
    # The unknown pickup drops out; the unknown dropoff counts as a destination.
    assert [(r.pickup_zone_key, r.trip_count, r.unique_destinations) for r in zone] == [(100, 2, 2)]
    hourly = gold.agg_hourly_metrics(fact, dates, zones).collect()
    assert [(r.pickup_borough, r.trip_count) for r in hourly] == [("Manhattan", 2)]
    safe = gold.trip_keys(staged, null_safe=True).filter("trip_key is null")
    assert safe.count() == 0


def test_staging_drops_each_bad_row(raw_trip):
    raw = raw_trip(
        {},
        dict(trip_distance="0"),
        dict(trip_distance=None),
        dict(fare_amount="-0.01"),
        dict(total_amount="-0.01"),
        dict(fare_amount=None),
        dict(pu_location_id=None),
        dict(do_location_id=None),
        dict(dropoff_datetime="2024-01-15 08:00:00"),
    )
    assert staging.trips(raw).count() == 1


def test_copies_and_ties_get_distinct_ids(raw_trip):
    raw = raw_trip({}, {}, dict(tip_amount=None), dict(do_location_id=201))
    rows = silver.trips(staging.trips(raw)).select("trip_id", "tip_amount", "has_tip").collect()
    assert len({r.trip_id for r in rows}) == 4
    assert [r.has_tip for r in rows if r.tip_amount is None] == [None]


def test_months_loaded_together_as_if_in_turn(raw_trip):
    raw = raw_trip({}, {}, dict(partition_date="2024-02-01"), dict(pu_location_id=101))
    rows = silver.monthly_batches(staging.trips(raw)).collect()
    assert sorted((r.pu_location_id, r.partition_date.month) for r in rows) == [
        (100, 1),
        (100, 2),
        (101, 1),
    ]
    assert len({r.trip_id for r in rows}) == 3


def test_calendar_borders(spark):
    hours = [5, 6, 7, 9, 10, 16, 17, 19, 20, 0]
    days = ["2024-01-19", "2024-01-20", "2024-01-21", "2024-01-22"]
    rows = [(f"{days[i % 4]} {h:02d}:59:59.999999",) for i, h in enumerate(hours)]
    dates = gold.dim_date(
        spark.createDataFrame(rows, "t string").selectExpr(
            "cast(t as timestamp_ntz) pickup_datetime"
        ),
        padded=False,
    )
    got = {r.trip_hour: r.time_of_day_bucket for r in dates.collect()}
    assert got == {
        0: "overnight",
        5: "overnight",
        6: "off_peak",
        7: "morning_peak",
        9: "morning_peak",
        10: "off_peak",
        16: "off_peak",
        17: "evening_peak",
        19: "evening_peak",
        20: "off_peak",
    }
    assert {r.day_of_week: (r.is_weekend, r.day_of_week_num) for r in dates.collect()} == {
        "Friday": (False, 5),
        "Saturday": (True, 6),
        "Sunday": (True, 0),
        "Monday": (False, 1),
    }


def test_wall_clock_hours_ignore_the_session_zone(spark):
    """02:30 does not exist on this day in New York, but it is what the meter said."""
    df = spark.createDataFrame([("2024-03-10 02:30:00", "2024-03-10 03:30:30")], "a string, b string")
    df = df.selectExpr("cast(a as timestamp_ntz) a", "cast(b as timestamp_ntz) b")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        row = df.select(
            calendar.hour_key(F.col("a")).alias("key"),
            calendar.hour_start(F.col("a")).alias("hour"),
            calendar.minutes_between(F.col("a"), F.col("b")).alias("minutes"),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert row.key == 2024031002
    assert row.hour == dt.datetime(2024, 3, 10, 2)
    assert row.minutes == Decimal("60.5")


def test_rounding_and_means(spark):
    df = spark.sql(
        "SELECT cast(-2.50 AS decimal(10,2)) neg, cast(0.01 AS decimal(10,2)) cent,"
        " cast(8 AS decimal(8,2)) eight, cast(0.05 AS decimal(20,2)) total, 2L n, 0L none"
    )
    row = df.select(
        measures.safe_ratio(F.col("neg"), F.col("eight")).alias("ratio"),
        measures.safe_ratio(F.col("neg"), F.lit(0)).alias("no_ratio"),
        measures.safe_pct(F.col("cent"), F.col("eight")).alias("pct"),
        measures.rounded_mean(F.col("total"), F.col("n")).alias("tie"),
        measures.rounded_mean(-F.col("total"), F.col("n")).alias("neg_tie"),
        measures.rounded_mean(F.col("total"), F.col("none")).alias("empty"),
    ).first()
    assert row.ratio == Decimal("-0.31") and row.no_ratio is None
    assert row.pct == Decimal("0.13")
    assert (row.tie, row.neg_tie, row.empty) == (Decimal("0.03"), Decimal("-0.03"), None)


def test_keys(spark):
    import hashlib

    row = spark.range(1).select(
        keys.surrogate_key(F.lit(1), F.lit(None), F.lit("x")).alias("key"),
        keys.hash64(F.lit("abc")).alias("h"),
        keys.hash64(F.lit(None).cast("string")).alias("no"),
    ).first()
    assert row.key == hashlib.md5(b"1|_null_|x").hexdigest()
    signed = int.from_bytes(hashlib.md5(b"abc").digest()[:8], "big", signed=True)
    assert row.h == signed and row.no is None


def test_zone_codes(spark, zone_csv):
    raw = bronze.conform_zones(files.read_zones(spark, zone_csv))
    rows = {r.location_id: r for r in silver.zones(staging.zones(raw)).collect()}
    assert {k: r.service_zone_code for k, r in rows.items()} == {
        100: "yellow",
        150: "boro",
        200: "unknown",
        250: "ewr",
    }
    assert {k for k, r in rows.items() if r.is_manhattan} == {100}
    flagged = gold.dim_zone(files.read_zone_seed(spark, zone_csv), airports=(200, 250))
    assert {r.zone_key for r in flagged.collect() if r.is_airport} == {200, 250}


def test_strict_rules(raw_trip):
    raw = raw_trip(
        {},
        dict(fare_amount="500.01"),
        dict(fare_amount="0"),
        dict(trip_distance="0.01"),
        dict(trip_distance="200.01"),
        dict(dropoff_datetime="2024-01-15 13:00:01"),
        dict(pickup_datetime="2023-12-31 23:59:59", dropoff_datetime="2024-01-01 00:10:00"),
        dict(tip_amount=None, fare_amount=None),
    )
    assert staging.clean_strict(raw).count() == 1
    row = staging.drop_reasons(raw).first().asDict()
    assert row["rows_in"] == 8 and row["rows_kept"] == 1
    assert [row[f"bad_{r}"] for r in ("fare_range", "distance_range", "duration_range")] == [3, 2, 1]
    assert row["bad_date_scope"] == 1
    # Wider bounds let the large fare and the long trip through.
    assert staging.clean_strict(raw, BOUNDS).count() == 3


def test_monitoring(spark, raw_trip):
    trips = raw_trip(*[{}] * 10, *[dict(partition_date="2024-02-01")] * 8)
    trips = trips.unionByName(raw_trip(*[dict(partition_date="2024-03-01")] * 6))
    assert [r.partition_date.month for r in monitor.volume_drop(trips).collect()] == [3]
    kept = monitor.retention(trips, trips.filter("month(partition_date) < 3").limit(18), trips)
    got = {r.partition_date.month: r.silver_retention_pct for r in kept.collect()}
    assert got == {1: 100, 2: 100, 3: 0}


def test_hot_groups_do_not_change_ids_or_keys(raw_trip):
    rows = [dict(dropoff_datetime=f"2024-01-15 09:{i % 60:02d}:00") for i in range(90)]
    rows += [dict(passenger_count=None)] * 30 + [dict(vendor_id=i) for i in range(9)]
    staged = staging.trips(raw_trip(*rows))
    cut = dict(hot_rows=10, copies_per_task=4)

    def ids(df, column):
        return sorted(
            (str(r[0]), r.dropoff_datetime) for r in df.select(column, "dropoff_datetime").collect()
        )

    assert ids(silver.trips(staged, **cut), "trip_id") == ids(silver.trips(staged), "trip_id")
    months = staged.unionByName(staged.withColumn("partition_date", F.add_months("partition_date", 1)))
    in_turn = silver.monthly_batches(months)
    assert ids(silver.monthly_batches(months, **cut), "trip_id") == ids(in_turn, "trip_id")
    assert in_turn._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert ids(gold.trip_keys(staged, **cut), "trip_key") == ids(gold.trip_keys(staged), "trip_key")


def test_large_dimensions_are_not_broadcast(spark, two_trips, zone_seed, monkeypatch):
    staged = staging.trips(two_trips)
    want = sorted(map(tuple, _star(spark, staged, zone_seed)[0].collect()))
    monkeypatch.setattr("tripmart.operators.lookup.small.__defaults__", (1,))
    fact = _star(spark, staged, zone_seed)[0]
    assert "ResolvedHint" not in fact._jdf.queryExecution().analyzed().toString()
    assert sorted(map(tuple, fact.collect())) == want


def test_shown_order(spark):
    df = spark.createDataFrame([(1,), (3,), (2,)], "trip_count int")
    assert [r[0] for r in gold.shown(df, "agg_zone_summary").collect()] == [3, 2, 1]
