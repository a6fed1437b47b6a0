"""Hard negatives by inner product, found with segment summaries.

A vector is cut into segments, and of each the mean and the deviation (root of the sum of squared
differences from the mean) are stored.  The inner product over a segment of length L is L times
the product of the means, plus or minus at most the product of the deviations.  The bounds of one
segment leave out most pairs that cannot matter; pairs left go to two segments, four, and so
on, and at last to exact products.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from llm.scratch import Scratch
from llm.vectors import commonest_length, matrix, whole_numbers

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
# Segments per vector, coarse to fine; each level halves the segments before it.
LEVELS = (1, 2, 4, 8)
# Bytes of the anchors that all executors hold at once; further anchors wait for the next scan.
ANCHOR_BYTES = 32 << 20
# Rows and anchors whose pairs are looked at together.
ROWS_AT_ONCE, ANCHORS_AT_ONCE = 4_096, 256
_NONE = np.iinfo(np.int64).min


def summaries(x: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """(means times the root of the length, deviations) of each vector's segments.

    Scaled so, the products of means need no further weight.
    """
    d = x.shape[1]
    cuts = np.arange(segments) * d // segments
    sizes = np.diff(np.r_[cuts, d])
    x = x.astype(float)
    means = np.add.reduceat(x, cuts, axis=1) / sizes
    off = x - np.repeat(means, sizes, axis=1)
    return means * np.sqrt(sizes), np.sqrt(np.add.reduceat(off * off, cuts, axis=1))


def levels(dims: int) -> list[int]:
    return [k for k in LEVELS if k <= dims]


def summarised(rows: DataFrame, dims: int) -> DataFrame:
    """`rows` with `means` and `deviations`: the summaries of all levels one after another."""
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("x"), dims)
            found = [summaries(x, k) for k in levels(dims)]
            width = sum(levels(dims))
            offsets = pa.array(range(0, width * len(x) + 1, width), pa.int32())
            lists = [
                pa.ListArray.from_arrays(offsets, pa.array(np.hstack(side).ravel()))
                for side in zip(*found, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *lists], names=[*names, "means", "deviations"]
            )

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema]
    schema = ", ".join([*fields, "means array<double>", "deviations array<double>"])
    return rows.mapInArrow(run, schema)


@dataclass
class Block:
    """Vectors with their summaries."""

    row: np.ndarray
    vec_id: np.ndarray
    label: np.ndarray
    x: np.ndarray
    means: np.ndarray
    deviations: np.ndarray

    @classmethod
    def of(cls, table: pa.Table | pa.RecordBatch, dims: int) -> Block:
        def column(name):
            found = table.column(name)
            return found.combine_chunks() if isinstance(found, pa.ChunkedArray) else found

        plain = [
            column(c).to_numpy(zero_copy_only=False).astype(np.int64)
            for c in ("row", "vec_id", "label")
        ]
        width = sum(levels(dims))
        lists = [matrix(column(c), n) for c, n in (("x", dims), ("means", width), ("deviations", width))]
        return cls(*plain, *lists)

    def __len__(self) -> int:
        return len(self.row)

    def part(self, which) -> Block:
        return Block(*[getattr(self, f)[which] for f in self.__dataclass_fields__])

    def norm(self) -> float:
        return float(np.sqrt((self.x.astype(float) ** 2).sum(axis=1).max())) if len(self) else 0.0


def products(a: np.ndarray, b: np.ndarray, largest: float) -> np.ndarray:
    """Exact inner products; `largest` is no less than any product of two norms."""
    if largest < 1 << 52:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    if largest < 1 << 55:
        return a @ b.T
    raise OverflowError("inner products are too large for 64-bit numbers")


class Best:
    """The best `k` rows of each query: by score, then smaller vec_id, then row."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.score = np.full((queries, k), _NONE)
        self.vec_id = np.zeros((queries, k), np.int64)
        self.row = np.zeros((queries, k), np.int64)

    def least(self) -> np.ndarray:
        """The score that a row must reach to count; the lowest number while there is room."""
        return self.score[:, -1]

    def offer(self, query: np.ndarray, score: np.ndarray, vec_id: np.ndarray, row: np.ndarray):
        if not len(query):
            return
        asked = np.unique(query)
        held = self.score[asked] != _NONE
        own = np.repeat(asked, self.k).reshape(held.shape)[held]
        query = np.r_[own, query]
        score = np.r_[self.score[asked][held], score]
        vec_id = np.r_[self.vec_id[asked][held], vec_id]
        row = np.r_[self.row[asked][held], row]
        order = np.lexsort((row, vec_id, -score, query))
        query = query[order]
        first = np.r_[True, query[1:] != query[:-1]]
        place = np.arange(len(query)) - np.maximum.accumulate(np.where(first, np.arange(len(query)), 0))
        chosen = place < self.k
        order, at = order[chosen], (query[chosen], place[chosen])
        self.score[at], self.vec_id[at], self.row[at] = score[order], vec_id[order], row[order]

    def rows(self) -> Iterator[np.ndarray]:
        query, place = np.nonzero(self.score != _NONE)
        at = (query, place)
        yield from (query, self.score[at], self.vec_id[at], self.row[at])


def bounded_pairs(
    anchors: Block, rows: Block, wanted: np.ndarray, low: np.ndarray, high: np.ndarray | None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, row, score) of the `wanted` pairs whose score lies in [low, high] of its anchor.

    Level by level, pairs whose bounds miss the interval are left out; anchors and rows
    without pairs drop out of the next level.
    """
    largest = anchors.norm() * rows.norm()
    # More than what rounding can make of a bound.
    slack = 0.5 + 1e-12 * largest
    a, r = np.arange(len(anchors)), np.arange(len(rows))
    start = 0
    for k in levels(anchors.x.shape[1]):
        part = slice(start, start + k)
        start += k
        some_a, some_r = wanted.any(axis=1), wanted.any(axis=0)
        a, r, wanted = a[some_a], r[some_r], wanted[some_a][:, some_r]
        if not wanted.size:
            return (np.zeros(0, np.int64),) * 3
        middle = anchors.means[a, part] @ rows.means[r, part].T
        room = anchors.deviations[a, part] @ rows.deviations[r, part].T + slack
        wanted = wanted & (middle + room >= low[a, None])
        if high is not None:
            wanted &= middle - room <= high[a, None]
    some_a, some_r = wanted.any(axis=1), wanted.any(axis=0)
    a, r, wanted = a[some_a], r[some_r], wanted[some_a][:, some_r]
    if not wanted.size:
        return (np.zeros(0, np.int64),) * 3
    scores = products(anchors.x[a], rows.x[r], largest)
    wanted &= scores >= low[a, None]
    if high is not None:
        wanted &= scores <= high[a, None]
    i, j = np.nonzero(wanted)
    return a[i], r[j], scores[i, j]


def _blocks(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[Block]:
    for batch in batches:
        for i in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield Block.of(batch.slice(i, ROWS_AT_ONCE), dims)


def _chunks(n: int) -> Iterator[slice]:
    for i in range(0, n, ANCHORS_AT_ONCE):
        yield slice(i, min(n, i + ANCHORS_AT_ONCE))


def _emitted(best: Best) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.int64()) for c in best.rows()], names=["query", "score", "vec_id", "row"]
    )


_FOUND = "query bigint, score bigint, vec_id bigint, row bigint"


def _merged(found: DataFrame, k: int) -> DataFrame:
    """The best `k` of what all tasks have found for each query, with `rank` from 1."""
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _positives(rows: DataFrame, held, dims: int, k: int) -> DataFrame:
    """The best `k` other rows of each anchor's label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors: Block = held.value
        best = Best(len(anchors), k)
        for block in _blocks(batches, dims):
            for part in _chunks(len(anchors)):
                some = anchors.part(part)
                same = (some.label[:, None] == block.label) & (some.row[:, None] != block.row)
                a, r, score = bounded_pairs(some, block, same, best.least()[part], None)
                best.offer(a + part.start, score, block.vec_id[r], block.row[r])
        yield _emitted(best)

    return _merged(rows.mapInArrow(run, _FOUND), k)


def interval(positive: np.ndarray, low_percent: int, high_percent: int):
    """Whole scores s with low_percent * positive <= 100 * s <= high_percent * positive."""
    return -((-low_percent * positive) // 100), (high_percent * positive) // 100


def _negatives(rows: DataFrame, held, dims: int, k: int) -> DataFrame:
    """The best `k` rows of another label in the interval of each (anchor, positive)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, lows, highs = held.value  # lows, highs: one row per anchor, one column per positive
        slots = lows.shape[1]
        best = Best(lows.size, k)
        for block in _blocks(batches, dims):
            for part in _chunks(len(anchors)):
                some = anchors.part(part)
                other = some.label[:, None] != block.label
                # What a row must reach now, for each positive.
                least = np.maximum(lows, best.least().reshape(lows.shape))[part]
                high = highs[part]
                open_ = least <= high
                low = np.where(open_, least, np.iinfo(np.int64).max).min(axis=1)
                other &= open_.any(axis=1)[:, None]
                a, r, score = bounded_pairs(some, block, other, low, high.max(axis=1))
                for s in range(slots):
                    fits = (score >= least[a, s]) & (score <= high[a, s])
                    i, j = a[fits], r[fits]
                    best.offer(
                        (i + part.start) * slots + s, score[fits], block.vec_id[j], block.row[j]
                    )
        yield _emitted(best)

    return _merged(rows.mapInArrow(run, _FOUND), k)


OUT = (
    "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint,"
    " negative_score bigint"
)


def _group(
    spark: SparkSession, rows: DataFrame, anchors: Block, dims: int, scratch: Scratch, settings
) -> DataFrame:
    """Hard negatives of one bounded group of anchors, from two scans of all rows."""
    positives, negatives, low_percent, high_percent = settings
    held = spark.sparkContext.broadcast(anchors)
    # At most `positives` rows per anchor of the group.
    found = _positives(rows, held, dims, positives).select("query", "rank", "score", "vec_id")
    table = found.toArrow()
    at = [table.column(c).to_numpy() for c in ("query", "rank", "score", "vec_id")]
    place = (at[0], at[1] - 1)
    score = np.zeros((len(anchors), positives), np.int64)
    ids = np.zeros_like(score)
    score[place], ids[place] = at[2], at[3]
    lows, highs = interval(score, low_percent, high_percent)
    missing = np.ones(score.shape, bool)
    missing[place] = False
    lows[missing], highs[missing] = 0, -1
    both = spark.sparkContext.broadcast((anchors, lows, highs))
    named = spark.createDataFrame(
        pa.table(
            {
                "query": at[0] * positives + place[1],
                "anchor_id": anchors.vec_id[at[0]],
                "positive_id": at[3],
                "positive_score": at[2],
            }
        )
    )
    best = _negatives(rows, both, dims, negatives)
    out = best.join(named, "query").select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
    written = scratch.write(out)
    held.unpersist()
    both.unpersist()
    return written


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column | str,
    *,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low_percent: int = 50,
    high_percent: int = 95,
    vector_column: str = "embedding",
) -> DataFrame:
    """For the rows that `is_anchor` (on vec_id) holds of: their positives' hard negatives.

    `vectors` has vec_id, label and `vector_column`; an entry counts as floor(256 * entry), and a score is
    the whole inner product with the anchor; higher is better, ties go to the smaller vec_id.  An anchor's
    positives are the best `positives` other rows of its label, its negatives for one of them
    the best `negatives` rows of other labels with low_percent * positive_score <= 100 *
    negative_score <= high_percent * positive_score.  Result: anchor_id, positive_id, rank (from
    1), negative_id, positive_score, negative_score.

    Left out: rows with a null vec_id, label or vector, with a null, NaN or infinite entry, and those
    whose vector is empty or not of the commonest length (of equals the longer).  Repeated rows
    are rows of their own: a copy of an anchor can be its positive, and is an anchor itself.  Pairs without a
    negative give no rows; nor do tables without anchors or with one label.  Further
    columns, whatever their names, are not read.

    All pairs of anchors and rows are looked at, by bounds or exactly.  Anchors are split into
    groups of ANCHOR_BYTES, which all tasks hold; each group scans the rows twice.
    A task gives at most the best few rows per anchor, whatever labels or copies abound.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "negatives")
    named = vectors.filter("vec_id is not null and label is not null").select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.col("label").cast("bigint").alias("label"),
        F.col(vector_column).alias("embedding"),
    )
    plain = scratch.write(whole_numbers(named, "embedding", SCALE, 0, ["vec_id", "label"]))
    dims, _ = commonest_length(plain)
    if not dims:
        return spark.createDataFrame([], OUT)
    rows = summarised(plain.filter(F.size("x") == dims), dims)
    rows = scratch.write(rows.withColumn("row", F.monotonically_increasing_id()))
    scratch.drop(plain)
    chosen = rows.filter(is_anchor)
    each = 8 * (3 + dims + 2 * sum(levels(dims)) + 6 * positives)
    groups = max(1, -(-chosen.count() * each // ANCHOR_BYTES))
    number = F.pmod(F.xxhash64("row"), F.lit(groups))
    out = None
    for g in range(groups):
        # About ANCHOR_BYTES: rows are dealt by hash.
        table = chosen.filter(number == g).toArrow()
        if not table.num_rows:
            continue
        settings = (positives, negatives, low_percent, high_percent)
        part = _group(spark, rows, Block.of(table, dims), dims, scratch, settings)
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], OUT) if out is None else out
