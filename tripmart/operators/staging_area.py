"""Cutting lineage through the shared checkpoint folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir.

    A local session without that setting uses a folder in its warehouse; on a cluster
    the setting is required, since executors and driver must see the same files.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_stages"


def staged(df: DataFrame) -> DataFrame:
    """`df` written once as Parquet to the shared folder and read back.

    Unlike a cached frame it survives lost executors, and unlike a checkpoint it
    can be read column by column.  Since results are lazy, the files go when the session ends.
    """
    return _written(df, session_folder(df.sparkSession))


def session_folder(spark: SparkSession) -> str:
    """A new folder beside the stages that goes when the session ends."""
    path = _new_path(spark)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return path


@contextmanager
def staged_meanwhile(df: DataFrame) -> Iterator[DataFrame]:
    """Like `staged`, for use within a block; the files are removed after it."""
    spark = df.sparkSession
    path = _new_path(spark)
    try:
        yield _written(df, path)
    finally:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _new_path(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/stage-{uuid.uuid4().hex}"


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
