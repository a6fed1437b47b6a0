"""Source files: the gate, parsing and constraints."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tripmart import schemas
from tripmart.errors import MissingColumns, SourceMissing
from tripmart.plans import bronze
from tripmart.sources import files
from tripmart.sources.jdbc import Split, equal_depth, jdbc_options, quantile_bounds

from tests.conftest import HEADER, JANUARY, TWO_TRIPS, write_lines


def test_csv_rows(spark, trip_csv):
    rows = bronze.conform_trips(files.read_trips(spark, trip_csv, JANUARY)).collect()
    assert len(rows) == 2 and {r.partition_date for r in rows} == {JANUARY}


def test_columns_go_by_name_and_more_are_fine(spark, tmp_path):
    names = HEADER.split(",")[::-1]
    values = TWO_TRIPS[0].split(",")[::-1]
    path = write_lines(
        tmp_path / "t.csv", [",".join(["extra", *names]), ",".join(["?", *values])]
    )
    row = bronze.conform_trips(files.read_trips(spark, path, JANUARY)).first()
    assert row.vendor_id == 1 and row.pickup_datetime == dt.datetime(2024, 1, 15, 8)


def test_parquet_equals_csv(spark, trip_csv, tmp_path):
    path = str(tmp_path / "t.parquet")
    typed = files.read_trips(spark, trip_csv, JANUARY).selectExpr(
        "cast(VendorID as bigint) VendorID",
        "cast(tpep_pickup_datetime as timestamp_ntz) tpep_pickup_datetime",
        "cast(tpep_dropoff_datetime as timestamp_ntz) tpep_dropoff_datetime",
        "cast(passenger_count as double) passenger_count",
        "cast(trip_distance as double) trip_distance",
        "cast(PULocationID as int) PULocationID",
        "cast(DOLocationID as int) DOLocationID",
        "cast(fare_amount as double) fare_amount",
        "cast(tip_amount as double) tip_amount",
        "cast(total_amount as double) total_amount",
    )
    typed.write.parquet(path)
    from_parquet = bronze.conform_trips(files.read_trips(spark, path, JANUARY))
    from_csv = bronze.conform_trips(files.read_trips(spark, trip_csv, JANUARY))
    assert sorted(from_parquet.collect()) == sorted(from_csv.collect())


def test_gate(spark, tmp_path, trip_csv):
    bad = write_lines(tmp_path / "bad.csv", ["col_a,col_b,col_c", "1,2,3"])
    with pytest.raises(MissingColumns) as error:
        files.read_trips(spark, bad, JANUARY)
    assert error.value.missing == sorted(schemas.TRIP_SOURCE_COLUMNS)
    with pytest.raises(SourceMissing):
        files.read_trips(spark, str(tmp_path / "none.parquet"), JANUARY)
    with pytest.raises(SourceMissing):
        files.read_trips(spark, write_lines(tmp_path / "t.json", ["{}"]), JANUARY)


@pytest.mark.parametrize(
    "field, value",
    [(0, "40000"), (4, "1234567.89"), (5, ""), (7, "abc"), (1, "")],
)
def test_values_that_do_not_fit_stop_the_load(spark, tmp_path, field, value):
    values = TWO_TRIPS[0].split(",")
    values[field] = value
    path = write_lines(tmp_path / "t.csv", [HEADER, ",".join(values)])
    with pytest.raises(Exception):
        bronze.enforce(
            bronze.conform_trips(files.read_trips(spark, path, JANUARY)), schemas.RAW_TRIPS
        ).collect()


def test_passengers_may_be_empty(spark, tmp_path):
    path = write_lines(tmp_path / "t.csv", [HEADER, TWO_TRIPS[0].replace(",2,3.5", ",,3.5")])
    row = bronze.conform_trips(files.read_trips(spark, path, JANUARY)).first()
    assert row.passenger_count is None


def test_required_columns_stop_the_load(raw_trip):
    with pytest.raises(Exception, match="do_location_id must not be NULL"):
        bronze.enforce(raw_trip(dict(do_location_id=None)), schemas.RAW_TRIPS).collect()


def test_paths():
    paths = files.trip_paths("/data/", [JANUARY])
    assert paths == {JANUARY: "/data/yellow_tripdata_2024-01.parquet"}


def test_jdbc_options():
    options = jdbc_options(
        "jdbc:x",
        "silver_trips",
        where="partition_date = '2024-01-01'",
        split=Split("pickup_hour_of_day", 0, 23, 8),
        user="u",
    )
    assert options["dbtable"].startswith("(SELECT * FROM silver_trips WHERE partition_date")
    assert options["partitionColumn"] == "pickup_hour_of_day"
    assert (options["lowerBound"], options["upperBound"]) == ("0", "23")
    assert options["numPartitions"] == "8" and options["user"] == "u"
    assert jdbc_options("jdbc:x", "t", fetch_size=1000) == {
        "url": "jdbc:x",
        "dbtable": "t",
        "fetchsize": "1000",
    }


def test_equal_depth_splits_hold_of_each_row_once(spark):
    """Skewed values, all alike, none at all; NULLs."""
    import random



    rng = random.Random(2)
    shapes = {
        "skewed": [int(rng.paretovariate(0.7)) % 10**9 for _ in range(3_000)] + [None] * 50,
        "alike": [5] * 500 + [None],
        "negative": [rng.randrange(-10**12, 10**12) for _ in range(500)],
        "none": [None, None],
        "empty": [],
    }
    for name, values in shapes.items():
        df = spark.createDataFrame([(v,) for v in values], "v bigint")
        conditions = equal_depth("v", quantile_bounds(df, "v", 8))
        counts = [df.filter(c).count() for c in conditions]
        assert sum(counts) == len(values), name
        hits = sum([F.coalesce(F.expr(c), F.lit(False)).cast("int") for c in conditions], F.lit(0))
        assert df.filter(hits != 1).count() == 0, name
        if name in ("skewed", "negative"):
            top = max(values.count(v) for v in set(values) - {None}) if name == "skewed" else 0
            assert max(counts[:-1]) <= len(values) / 8 * 1.5 + top, (name, counts)
    doubles = spark.createDataFrame([(x / 7,) for x in range(700)], "v double")
    conditions = equal_depth("v", quantile_bounds(doubles, "v", 4))
    assert sum(doubles.filter(c).count() for c in conditions) == 700
