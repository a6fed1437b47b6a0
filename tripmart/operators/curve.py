"""Orders in which rows near each other in two or more columns lie near each other in files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bits of each column on the curve, for two columns; more columns get fewer.
BITS = 16


def spread(value: Column, gap: int, bits: int = BITS) -> Column:
    """The bits of `value` with `gap` zeros between them."""
    out = F.lit(0).cast("bigint")
    for i in range(bits):
        bit = F.shiftright(value, i).bitwiseAND(F.lit(1).cast("bigint"))
        out = out.bitwiseOR(F.shiftleft(bit, i * (gap + 1)))
    return out


def z_value(*values: Column, bits: int = BITS) -> Column:
    """Bits of non-negative whole numbers taken in turns, those of the first lowest (Z-order)."""
    out = F.lit(0).cast("bigint")
    for place, value in enumerate(values):
        wide = spread(value.cast("bigint"), len(values) - 1, bits)
        out = out.bitwiseOR(F.shiftleft(wide, place))
    return out


def scaled(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> list[Column]:
    """Each numeric column as a number of so many bits, from its least to its greatest value.

    A NULL counts as the least value.  One pass over `df` reads the bounds.
    """
    bounds = df.agg(
        *[f(F.col(c).cast("double")).alias(f"{k}{i}") for i, c in enumerate(columns) for k, f in (("a", F.min), ("b", F.max))]
    ).first()
    top = (1 << bits) - 1
    out = []
    for i, c in enumerate(columns):
        low, high = bounds[f"a{i}"], bounds[f"b{i}"]
        width = (high or 0) - (low or 0)
        if not width:
            out.append(F.lit(0).cast("bigint"))
            continue
        share = (F.col(c).cast("double") - F.lit(low)) / F.lit(width)
        out.append(F.coalesce(F.floor(share * top), F.lit(0)).cast("bigint"))
    return out


def along_curve(df: DataFrame, columns: Sequence[str], parts: int, first: Sequence[str] = ()) -> DataFrame:
    """`df` in `parts` ranges of `first` and the curve through `columns`, each range sorted."""
    order = [*first, "_z"]
    keyed = df.withColumn("_z", z_value(*scaled(df, columns)))
    return keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("_z")
