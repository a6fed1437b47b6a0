"""Joins of a large table with a dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A dimension up to this many rows is sent to every executor.  Rows hold a few
# short columns, so this stays around ten megabytes.
MAX_BROADCAST_ROWS = 100_000


def small(dim: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """`dim` marked for broadcast if counting shows it is small, else unchanged.

    Unmarked, the join shuffles both sides and adaptive execution splits hot keys.
    """
    return F.broadcast(dim) if dim.count() <= max_rows else dim


def key_or_default(key: Column, default: int) -> Column:
    """The dimension key found by a left join, or the unknown member."""
    return F.coalesce(key, F.lit(default))
