"""The supplied order tables in the shape of trips and zones.

Line items become trips, nations become zones.  All rows of all tables are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The borough that plays Manhattan in the supplied tables.
CENTRAL_BOROUGH = "ASIA"


# Types of the columns used; stating them saves a look at the files.
_COLUMNS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
    " l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
    "customer": "c_custkey bigint, c_nationkey int",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(_COLUMNS[name]).parquet(f"{folder}/{name}.parquet")


def trip_rows(spark: SparkSession, folder: str) -> int:
    """Number of trips, from the file footers."""
    return table(spark, folder, "lineitem").count()


def _minutes(count) -> F.Column:
    return F.make_dt_interval(mins=count.cast("int"))


def _hundredths(name: str) -> F.Column:
    """A double with two digits as a whole number; cheaper than a cast to decimal."""
    return F.rint(F.col(name) * 100).cast("bigint")


def _amount(hundredths: F.Column) -> F.Column:
    return (hundredths.cast("decimal(12,0)") * F.lit("0.01").cast("decimal(3,2)")).cast(
        "decimal(10,2)"
    )


def trip_source(spark: SparkSession, folder: str) -> DataFrame:
    """Line items under the column names of a trip file, with their month."""
    orders = table(spark, folder, "orders")
    customers = table(spark, folder, "customer")
    suppliers = table(spark, folder, "supplier")
    # Customers meet the orders, which are fewer than the line items.
    ordered = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    joined = (
        table(spark, folder, "lineitem")
        .join(ordered.drop("o_custkey", "c_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    )
    fare = _hundredths("l_extendedprice")
    tip = F.call_function("div", fare * _hundredths("l_discount") + 50, F.lit(100))
    total = F.call_function("div", fare * (100 + _hundredths("l_tax")) + 50, F.lit(100))
    pickup = F.col("o_orderdate") + _minutes((F.col("o_orderkey") * 37) % 1440)
    dropoff = F.col("l_shipdate") + _minutes(
        (F.col("l_partkey") * 53 + F.col("l_linenumber") * 7) % 1440
    )
    return joined.select(
        (F.col("l_suppkey") % 4).alias("VendorID"),
        pickup.alias("tpep_pickup_datetime"),
        dropoff.alias("tpep_dropoff_datetime"),
        F.col("l_linenumber").alias("passenger_count"),
        _amount(_hundredths("l_quantity") - 100).alias("trip_distance"),
        (F.col("s_nationkey") + 1).alias("PULocationID"),
        (F.col("c_nationkey") + 1).alias("DOLocationID"),
        _amount(fare).alias("fare_amount"),
        _amount(tip).alias("tip_amount"),
        _amount(total).alias("total_amount"),
        F.trunc(F.col("o_orderdate").cast("date"), "month").alias("partition_date"),
    )


def zone_source(spark: SparkSession, folder: str) -> DataFrame:
    """Nations under the column names of a zone file."""
    nations = table(spark, folder, "nation")
    regions = table(spark, folder, "region")
    kinds = F.array(*[F.lit(k) for k in ("Yellow Zone", "Boro Zone", "EWR", "Airports")])
    return nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey")).select(
        (F.col("n_nationkey") + 1).cast("smallint").alias("LocationID"),
        F.col("r_name").alias("Borough"),
        F.col("n_name").alias("Zone"),
        F.element_at(kinds, F.col("n_nationkey") % 4 + 1).alias("service_zone"),
    )
