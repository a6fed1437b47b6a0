"""Which partitions may hold a key: a Bloom filter and a key range per partition.

The filter is cut into blocks of 512 bits.  A key has one block, in which it sets one bit in each
of sixteen 32-bit lanes (two to a number).  A key that is there is always found; one that is not is
taken to be there about once in 10**8 times, which costs a look at a partition and nothing else.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.operators.summaries import Summary
from tripmart.schemas import Table

BITS_PER_KEY, BLOCK_BITS = 48, 512
_WORDS = BLOCK_BITS // 64
# Sizes of filters grow in such steps, so that many partitions share one and a key is placed once.
_STEPS_PER_DOUBLING = 4


def blocks_for(keys: int) -> int:
    """Blocks of a partition's filter, a little more than its keys need."""
    least = max(1.0, keys * BITS_PER_KEY / BLOCK_BITS)
    step = math.ceil(math.log2(least) * _STEPS_PER_DOUBLING)
    return math.ceil(2 ** (step / _STEPS_PER_DOUBLING))


def _masks(keys: Sequence[str]) -> list[Column]:
    """The numbers of a block in which the key's bits are set: two lanes each."""
    out = []
    for half in range(2):
        bits = F.xxhash64(*[F.col(k) for k in keys], F.lit(f"lanes {half}"))

        def lane(i: int, bits: Column = bits) -> Column:
            return F.shiftrightunsigned(bits, 5 * i).bitwiseAND(F.lit(31)).cast("int")

        one = F.lit(1).cast("bigint")
        for i in range(0, _WORDS, 2):
            low = F.call_function("shiftleft", one, lane(i))
            high = F.call_function("shiftleft", one, lane(i + 1) + 32)
            out.append(low.bitwiseOR(high))
    return out


def _hashed(keys: Sequence[str]) -> Column:
    """What stands for a key in a filter: its block and its bits come from this."""
    return F.xxhash64(*keys).alias("_hash")


def _block() -> Column:
    return F.pmod("_hash", "blocks").alias("block")


def _bits() -> list[Column]:
    return [mask.alias(f"m{i}") for i, mask in enumerate(_masks(["_hash"]))]


def _not_null(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(keys))


class KeyIndex(Summary):
    """The index of a table by its keys; NULL keys, which never match, are left out."""

    def __init__(self, store, table: Table):
        self.keys = list(table.keys)
        part = table.schema[table.partition_by]
        key = T.StructType([T.StructField(k, table.schema[k].dataType) for k in self.keys])
        words = [T.StructField(f"w{i}", T.LongType()) for i in range(_WORDS)]
        schema = T.StructType(
            [
                T.StructField("blocks", T.LongType()),
                T.StructField("block", T.LongType()),
                T.StructField("low", key),
                T.StructField("high", key),
                *words,
                part,
            ]
        )
        # Indexes named `keys` were made of other bits; a table that has one gets a new one.
        super().__init__(store, table, "key_hashes", schema, self._built)

    def _built(self, df: DataFrame) -> DataFrame:
        part = self.base.partition_by
        keyed = _not_null(df.select(part, *self.keys), self.keys)
        whole = F.struct(*self.keys)
        sizes = keyed.groupBy(part).agg(
            F.count(F.lit(1)).alias("_keys"), F.min(whole).alias("low"), F.max(whole).alias("high")
        )
        # One row per partition that is made anew.
        rows = [(r[part], blocks_for(r["_keys"]), r["low"], r["high"]) for r in sizes.collect()]
        fields = {f.name: f for f in self.table.schema}
        held = T.StructType([fields[c] for c in (part, "blocks", "low", "high")])
        sized = F.broadcast(df.sparkSession.createDataFrame(rows, held))
        # Keys go to their blocks as hashes; bits, which take many times the room, are set there.
        dealt = (
            keyed.select(part, _hashed(self.keys))
            .join(sized.select(part, "blocks"), part)
            .select(part, _block(), "_hash")
            .repartition(part, "block")
        )
        return (
            dealt.select(part, "block", *_bits())
            .groupBy(part, "block")
            .agg(*[F.bit_or(f"m{i}").alias(f"w{i}") for i in range(_WORDS)])
            .join(sized, part)
        )

    def partitions_that_may_hold(
        self, source: DataFrame, among: Sequence[object]
    ) -> list[object]:
        """Those `among` these partitions that may hold a key of `source`.

        The index must be up to date for them.  Keys are dealt by block, index rows are too; what
        comes out of a task is at most one value per partition.
        """
        if not among:
            return []
        part = self.base.partition_by
        index = self.read(F.col(part).isin(list(among)))
        sizes = [r[0] for r in index.select("blocks").distinct().collect()]
        if not sizes:
            return []
        keys = _not_null(source.select(*self.keys), self.keys)
        sized = keys.withColumn("blocks", F.explode(F.array(*[F.lit(n) for n in sizes])))
        sized = sized.select("blocks", _hashed(self.keys), F.struct(*self.keys).alias("key"))
        # Probes meet their blocks as hashes, too.
        probes = sized.select("blocks", _block(), "_hash", "key")
        i, p = index.alias("i"), probes.alias("p")
        hit = (F.col("i.blocks") == F.col("p.blocks")) & (F.col("i.block") == F.col("p.block"))
        hit &= (F.col("p.key") >= F.col("i.low")) & (F.col("p.key") <= F.col("i.high"))
        for w, mask in enumerate(_masks(["p._hash"])):
            hit &= F.col(f"i.w{w}").bitwiseAND(mask) == mask
        found = i.join(p, hit, "left_semi").select(part).distinct()
        return sorted(r[0] for r in found.collect())
