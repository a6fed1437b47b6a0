"""Month ranges."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def spine(bounds: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """Every first of month from `start` to `end`, inclusive, of each row of bounds."""
    months = F.sequence(
        F.trunc(F.col(start), "month"), F.trunc(F.col(end), "month"), F.expr("interval 1 month")
    )
    return bounds.select(F.explode(months).alias("month"))


def month_list(spark: SparkSession, start: dt.date, end: dt.date) -> list[dt.date]:
    """The months of a date range, for planning a backfill."""
    if start > end:
        raise ValueError("start must not be after end")
    bounds = spark.createDataFrame([(start, end)], "start date, end date")
    return sorted(row["month"] for row in spine(bounds).collect())
