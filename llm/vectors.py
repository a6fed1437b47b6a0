"""Vector columns as whole numbers, for the operators on embeddings."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.shipping import ship

# Whole numbers beyond this would not leave room for sums.
LARGEST = float(1 << 61)


def finite_rows(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(which rows are lists of finite numbers, their lengths, their entries one after another)."""
    lengths = pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False)
    entries = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    bad = np.r_[0, np.cumsum(~np.isfinite(entries))]
    ends = np.cumsum(lengths, dtype=np.int64)
    sound = column.is_valid().to_numpy(zero_copy_only=False) & (bad[ends] == bad[ends - lengths])
    return sound, lengths[sound], entries[np.repeat(sound, lengths)]


def whole_numbers(
    df: DataFrame, vector: str, scale: int, offset: int, keep: Sequence[str]
) -> DataFrame:
    """The `keep` columns and `x`: floor(scale * entry) + offset of each entry as a double.

    Rows whose vector is null or has a null or non-finite entry are left out.  Entries that do
    not fit 64-bit numbers are an error.
    """
    ship(df.sparkSession)
    fields = [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sound, lengths, entries = finite_rows(batch.column(len(keep)))
            scaled = np.floor(scale * entries)
            if len(scaled) and np.abs(scaled).max() > LARGEST:
                raise OverflowError("a vector has entries too large for 64-bit numbers")
            offsets = pa.array(np.r_[0, np.cumsum(lengths)], pa.int32())
            x = pa.ListArray.from_arrays(offsets, pa.array(scaled.astype(np.int64) + offset))
            kept = batch.filter(pa.array(sound))
            yield pa.RecordBatch.from_arrays(
                [*kept.columns[: len(keep)], x], names=[*keep, "x"]
            )

    return df.select(*keep, vector).mapInArrow(run, ", ".join([*fields, "x array<bigint>"]))


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Lists of `dims` entries each as the rows of a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dims)


def commonest_length(rows: DataFrame) -> tuple[int, int]:
    """(length, number of rows) of the commonest length of `x`, the longer of equals; zeros if none.

    Empty vectors count as no vectors.
    """
    sizes = rows.groupBy(F.size("x").alias("d")).count().filter("d > 0")
    top = sizes.orderBy(F.desc("count"), F.desc("d")).first()
    return (top["d"], top["count"]) if top else (0, 0)
