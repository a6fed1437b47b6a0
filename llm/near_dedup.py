"""Near-duplicate documents: one-permutation MinHash, star candidates, exact check."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.carrying import carrying
from llm.linking import bucket_members, linked
from llm.minhash import Bands
from llm.scratch import Scratch
from llm.shingles import jaccard, shingle_sets
from llm.shipping import ship

# At similarity 0.8, a pair shares no bucket with a chance of 3e-6.
BANDS, ROWS = 24, 4
# Rows handed to Python at once while texts are compared; long texts come alone.
PAIR_BYTES = 8 << 20


def text_key(text: Column) -> list[Column]:
    """128 bits that stand for a text."""
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit("second"), text).alias("k2")]


def sketches(texts: DataFrame, size: int, lower: bool, bands: Bands) -> DataFrame:
    """Adds n_shingles and buckets (empty without words) to rows with a `text` column.

    `text` itself is left out of the result.
    """
    kept = [f for f in texts.schema if f.name != "text"]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("text").cast(pa.binary())
            sets = shingle_sets([t or b"" for t in column.to_pylist()], size, lower)
            counts, keys = [], []
            for s in sets:
                counts.append(len(s))
                keys.append(bands.keys(s).tobytes() if len(s) else b"")
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(f.name) for f in kept],
                    pa.array(counts, pa.int64()),
                    pa.array(keys, pa.binary()),
                ],
                names=[*[f.name for f in kept], "n_shingles", "buckets"],
            )

    return texts.mapInArrow(sketch, f"{fields}, n_shingles bigint, buckets binary")


def exploded(nodes: DataFrame, bands: Bands) -> DataFrame:
    """(bucket, node) of rows with `buckets`."""
    starts = F.sequence(F.lit(0), F.lit(bands.bands - 1))
    return (
        nodes.filter(F.octet_length("buckets") > 0)
        .select("node", "buckets", F.explode(starts).alias("i"))
        .select(
            F.conv(F.hex(F.substring("buckets", F.col("i") * 8 + 1, F.lit(8))), 16, -10)
            .cast("bigint")
            .alias("bucket"),
            "node",
        )
    )


# Texts or packed sets in, sorted sets of hashes out.
Sets = Callable[[list[bytes]], Iterator[np.ndarray]]


def word_sets(size: int, lower: bool) -> Sets:
    return lambda texts: shingle_sets(texts, size, lower)


def _compared(pairs: DataFrame, texts: DataFrame, sets: Sets, differences: bool) -> DataFrame:
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, None
        for batch in batches:
            for part in _slices(batch):
                a, b = part.column("a").to_pylist(), part.column("b").to_pylist()
                one = part.column("text_a").cast(pa.binary())
                other = part.column("text_b").cast(pa.binary()).to_pylist()
                out = []
                for i, s in enumerate(sets([t or b"" for t in other])):
                    if a[i] != last:
                        last = a[i]
                        held = next(sets([one[i].as_py() or b""]))
                    out.append(measure(held, s))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a, pa.int64()), pa.array(b, pa.int64()), *columns(out)],
                    names=["a", "b", *names],
                )

    def similarity(x, y):
        same, union = jaccard(x, y)
        return same / union if union else 0.0

    def apart(x, y):
        return len(x), np.setdiff1d(x, y, True), np.setdiff1d(y, x, True)

    if differences:
        measure, names = apart, ["size_a", "lost", "gained"]

        def columns(out):
            sizes, *lists = zip(*out, strict=True) if out else ([], [], [])
            kind = pa.list_(pa.int64())
            return [
                pa.array(sizes, pa.int64()),
                *[pa.array([v.view(np.int64) for v in x], kind) for x in lists],
            ]

        return both.mapInArrow(
            rows,
            "a bigint, b bigint, size_a bigint, lost array<bigint>, gained array<bigint>",
        )
    measure, names = similarity, ["similarity"]

    def columns(out):
        return [pa.array(out, pa.float64())]

    return both.mapInArrow(rows, "a bigint, b bigint, similarity double")


def similarities(pairs: DataFrame, texts: DataFrame, sets: Sets) -> DataFrame:
    """(a, b, similarity): Jaccard of the full shingle sets of each pair.

    `texts` has (node, text), where `sets` reads the text.  Rows come sorted by `a`, so that the set of a hub is made once
    for all its pairs in a task.
    """
    return _compared(pairs, texts, sets, False)


def differences(pairs: DataFrame, texts: DataFrame, sets: Sets) -> DataFrame:
    """(a, b, size_a, lost, gained): what the set of b lacks of that of a, and has beyond."""
    return _compared(pairs, texts, sets, True)


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    step = max(1, int(batch.num_rows * PAIR_BYTES / max(batch.nbytes, 1)))
    for i in range(0, batch.num_rows, step):
        yield batch.slice(i, step)


@carrying("n_shingles", "component_id", "kept")
def near_duplicates(
    docs: DataFrame,
    *,
    size: int = 5,
    threshold: float = 0.8,
    lower: bool = True,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """`docs` with n_shingles, component_id and kept.

    A document's set holds its distinct runs of `size` words (white space separates, A-Z
    count as a-z); fewer words are one run.  Documents are linked where the exact
    Jaccard similarity is `threshold` or more.  component_id is the smallest doc_id
    reachable over links, itself included; kept says that it is the own one.

    Equal texts are one node, so exact copies cost one row each.  Null or empty texts,
    or such without words, have n_shingles 0, are linked with nothing and kept.  Rows
    with equal doc_id are told apart by text; a null doc_id ranks after all others,
    and a component without any other has a null component_id and keeps all its rows.
    Further columns pass through; existing columns of the added names are replaced.
    """
    ship(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "near")
    plan = Bands(bands, rows)
    added = ("n_shingles", "component_id", "kept")
    base = docs.drop(*added)
    keyed = docs.select("doc_id", "text", *text_key(F.col("text")))
    made = sketches(keyed, size, lower, plan)
    nodes = scratch.write(
        made.groupBy("k1", "k2")
        .agg(
            F.min("doc_id").alias("smallest"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("buckets").alias("buckets"),
        )
        .withColumn("node", F.monotonically_increasing_id())
    )
    members = scratch.write(bucket_members(exploded(nodes, plan)))
    wanted = members.select("node").distinct().join(
        nodes.select("node", "k1", "k2", F.col("smallest").alias("doc_id")), "node"
    )
    found = docs.select("doc_id", "text", *text_key(F.col("text"))).alias("d")
    w = wanted.alias("w")
    texts = scratch.write(
        found.join(
            w,
            (F.col("d.k1") == F.col("w.k1"))
            & (F.col("d.k2") == F.col("w.k2"))
            & F.col("d.doc_id").eqNullSafe(F.col("w.doc_id")),
        )
        .groupBy("node")
        .agg(F.first("text").alias("text"))
    )
    placed = linked(
        members,
        lambda pairs: similarities(pairs, texts, word_sets(size, lower)),
        lambda pairs: differences(pairs, texts, word_sets(size, lower)),
        threshold,
        scratch,
    )
    labels = nodes.join(placed, "node", "left").select(
        "k1", "k2", "smallest", "n_shingles", F.coalesce("component", "node").alias("component")
    )
    roots = labels.groupBy("component").agg(F.min("smallest").alias("component_id"))
    final = scratch.write(
        labels.join(roots, "component").select("k1", "k2", "n_shingles", "component_id")
    ).alias("f")
    k1, k2 = text_key(F.col("text"))
    out = base.withColumns({"_k1": k1, "_k2": k2})
    # Without words there is nothing to link: each such document is its own component.
    alone = F.col("f.n_shingles") == 0
    own = F.when(alone, F.col("d.doc_id")).otherwise(F.col("f.component_id"))
    return (
        out.alias("d")
        .join(final, (F.col("d._k1") == F.col("f.k1")) & (F.col("d._k2") == F.col("f.k2")))
        .select(
            *[F.col(f"d.`{c}`") for c in base.columns],
            F.col("f.n_shingles").cast("bigint").alias("n_shingles"),
            own.alias("component_id"),
            F.coalesce(F.col("d.doc_id").eqNullSafe(own), F.lit(True)).alias("kept"),
        )
    )
