"""Which part of a source is new."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the watermark of an empty target.
BEGINNING = dt.date(1900, 1, 1)


def high_watermark(target: DataFrame, column: str = "partition_date") -> dt.date:
    """Largest loaded partition date; reads the partition column only."""
    top = target.agg(F.max(column)).first()[0]
    return BEGINNING if top is None else top


def newer_than(
    source: DataFrame, target: DataFrame, column: str = "partition_date"
) -> DataFrame:
    """Source rows past the target's watermark."""
    return past(source, high_watermark(target, column), column)


def past(
    source: DataFrame, watermark: dt.date | None, column: str = "partition_date"
) -> DataFrame:
    """Source rows past a watermark, all if there is none.

    The watermark is a literal, so it prunes partitions when the scan is planned.
    """
    return source.filter(F.col(column) > F.lit(watermark or BEGINNING))


def in_partitions(
    source: DataFrame, values: Sequence[dt.date], column: str = "partition_date"
) -> DataFrame:
    """Source rows of named partitions, by partition pruning."""
    return source.filter(F.col(column).isin(list(values)))
