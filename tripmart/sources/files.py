"""Trip and zone files."""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart import schemas
from tripmart.errors import MissingColumns, SourceMissing

# Fixed value: the name of a monthly file.
TRIP_FILE = "yellow_tripdata_{month:%Y-%m}.parquet"


def trip_path(root: str, month: dt.date) -> str:
    return f"{root.rstrip('/')}/{TRIP_FILE.format(month=month)}"


def trip_paths(root: str, months: Sequence[dt.date]) -> dict[dt.date, str]:
    return {month: trip_path(root, month) for month in months}


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(hadoop_path)


def fingerprint(spark: SparkSession, path: str) -> str | None:
    """What tells a delivered file, or folder of files, from another delivery; None if there is none.

    Names, lengths and times of change; no content is read.
    """
    if not path_exists(spark, path):
        return None
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    parts = sorted(
        f"{s.getPath().getName()}:{s.getLen()}:{s.getModificationTime()}"
        for s in fs.listStatus(hadoop_path)
        if s.isFile()
    )
    return hashlib.sha256("\n".join(parts).encode()).hexdigest()


def open_source(spark: SparkSession, path: str) -> DataFrame:
    """The file's rows, lazily; only its footer or header is read here."""
    if not path_exists(spark, path):
        raise SourceMissing(f"no such source: {path}")
    suffix = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if suffix == "parquet":
        return spark.read.parquet(path)
    if suffix == "csv":
        # Header names, not positions, pick the columns; all of them are text here.
        return spark.read.option("header", True).option("mode", "FAILFAST").csv(path)
    raise SourceMissing(f"unsupported format of {path}: expected .parquet or .csv")


def require_columns(df: DataFrame, columns: Sequence[str], table: str) -> None:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise MissingColumns(table, missing)


def _plain_names(df: DataFrame) -> DataFrame:
    """Header names without blanks around them."""
    return df.toDF(*[name.strip() for name in df.columns])


def _is_csv(path: str) -> bool:
    return path.rstrip("/").lower().endswith(".csv")


def _filled(name: str) -> Column:
    """A CSV field that must not be empty."""
    value = F.col(name)
    return F.when(value.isNull(), F.raise_error(F.lit(f"empty {name}"))).otherwise(value)


def read_trips(
    spark: SparkSession, path: str, partition_date: dt.date, *, strict: bool = True
) -> DataFrame:
    """Source columns of one trip file plus the month it was delivered for.

    An empty CSV field that must not be empty is an error, or NULL if not `strict`.
    """
    df = _plain_names(open_source(spark, path))
    require_columns(df, schemas.TRIP_SOURCE_COLUMNS, "raw_trips")
    columns = [F.col(c) for c in schemas.TRIP_SOURCE_COLUMNS]
    if strict and _is_csv(path):
        columns = [
            F.col(c) if c == "passenger_count" else _filled(c).alias(c)
            for c in schemas.TRIP_SOURCE_COLUMNS
        ]
    return df.select(*columns, F.lit(partition_date).alias("partition_date"))


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """Source columns of a zone file."""
    df = _plain_names(open_source(spark, path))
    require_columns(df, schemas.ZONE_SOURCE_COLUMNS, "raw_zones")
    if not _is_csv(path):
        return df.select(*schemas.ZONE_SOURCE_COLUMNS)
    texts = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in schemas.ZONE_SOURCE_COLUMNS[1:]]
    return df.select(_filled("LocationID").alias("LocationID"), *texts)


def read_zone_seed(spark: SparkSession, path: str) -> DataFrame:
    """The zone lookup the gold dimension is built from, keyed by a short id."""
    return read_zones(spark, path).withColumn("LocationID", F.col("LocationID").cast("smallint"))
