"""Keyed merges of two tables as plain joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.errors import DuplicateKeys


def _some_null(keys: Sequence[str]) -> Column:
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    return missing


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their count; NULL keys are left out."""
    return (
        df.filter(~_some_null(keys))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 1)
    )


def none_repeated(df: DataFrame, keys: Sequence[str]) -> bool:
    """Whether all keys differ for certain; `df` is read once, and hashes of its keys are shuffled.

    Where two rows share a hash this cannot tell: keys are to be compared themselves then.
    """
    hashed = df.filter(~_some_null(keys)).select(F.xxhash64(*keys).alias("_hash"))
    return not repeated_keys(hashed, ["_hash"]).limit(1).collect()


def require_unique(df: DataFrame, keys: Sequence[str], table: str) -> None:
    if none_repeated(df, keys):
        return
    sample = repeated_keys(df, keys).limit(1).collect()
    if sample:
        shown = ", ".join(f"{k}={sample[0][k]}" for k in keys)
        raise DuplicateKeys(f"{table}: {sample[0]['n']} source rows share {shown}")


def untouched(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key is not in the source; NULL keys never match.

    Rows with a NULL key stay out of the join, where they would all go to one
    task.  Their scan is skipped wherever file statistics show no NULL.
    """
    keyless = target.filter(_some_null(keys))
    keyed = target.filter(~_some_null(keys))
    return keyed.join(source.select(*keys), list(keys), "left_anti").select(
        *target.columns
    ).unionByName(keyless)


def upserted(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target after matched rows are replaced by, and new rows added from, the source."""
    return untouched(target, source, keys).unionByName(source.select(*target.columns))


def with_partitions_replaced(
    target: DataFrame, batch: DataFrame, values: Sequence[object], column: str
) -> DataFrame:
    """Target after the rows of the named partitions give way to the batch."""
    kept = target.filter(~F.col(column).isin(list(values)) | F.col(column).isNull())
    return kept.unionByName(batch.select(*target.columns))
