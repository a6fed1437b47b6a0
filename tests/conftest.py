from __future__ import annotations

import datetime as dt
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tripmart-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


HEADER = (
    "VendorID,tpep_pickup_datetime,tpep_dropoff_datetime,passenger_count,trip_distance,"
    "PULocationID,DOLocationID,fare_amount,tip_amount,total_amount"
)
TWO_TRIPS = [
    "1,2024-01-15 08:00:00,2024-01-15 08:20:00,2,3.5,100,200,14.50,2.00,16.50",
    "2,2024-01-15 09:00:00,2024-01-15 09:35:00,1,8.2,150,250,28.00,5.00,33.00",
]
ZONES = [
    "LocationID,Borough,Zone,service_zone",
    "100,Manhattan,Midtown,Yellow Zone",
    "150,Brooklyn,Park Slope,Boro Zone",
    "200,Queens,JFK Airport,Airports",
    "250,EWR,Newark Airport,EWR",
]
JANUARY = dt.date(2024, 1, 1)


def write_lines(path, lines):
    Path(path).write_text("\n".join(lines) + "\n")
    return str(path)


@pytest.fixture
def trip_csv(tmp_path):
    return write_lines(tmp_path / "trips.csv", [HEADER, *TWO_TRIPS])


@pytest.fixture
def zone_csv(tmp_path):
    return write_lines(tmp_path / "zones.csv", ZONES)


@pytest.fixture
def raw_trip(spark):
    """Builds typed raw trips from partial rows; everything not given has a default."""

    defaults = dict(
        vendor_id=1,
        pickup_datetime="2024-01-15 08:00:00",
        dropoff_datetime="2024-01-15 08:20:00",
        passenger_count=2,
        trip_distance="3.5",
        pu_location_id=100,
        do_location_id=200,
        fare_amount="14.50",
        tip_amount="2.00",
        total_amount="16.50",
        partition_date="2024-01-01",
    )
    types = dict(
        vendor_id="smallint",
        pickup_datetime="timestamp_ntz",
        dropoff_datetime="timestamp_ntz",
        passenger_count="smallint",
        trip_distance="decimal(8,2)",
        pu_location_id="smallint",
        do_location_id="smallint",
        fare_amount="decimal(10,2)",
        tip_amount="decimal(10,2)",
        total_amount="decimal(10,2)",
        partition_date="date",
    )

    def build(*rows):
        full = [{**defaults, **row} for row in rows]
        text = [tuple(None if r[c] is None else str(r[c]) for c in defaults) for r in full]
        df = spark.createDataFrame(text, ", ".join(f"{c} string" for c in defaults))
        return df.selectExpr(*[f"cast({c} as {t}) {c}" for c, t in types.items()])

    return build
