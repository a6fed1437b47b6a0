"""Benchmark decontamination with a generalised suffix automaton of the test items."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.automaton import SuffixAutomaton
from llm.scratch import Scratch

WINDOW = 10
# Words of items in one automaton (about 150 MB of Python objects); more items make more
# automata, through which all documents pass one after the other.
BLOCK_WORDS = 300_000
# Longer items are cut into pieces that overlap by a window less a word.
PIECE_WORDS = 20_000

_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_TO_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)
_ADDED = ("n_words", "n_hit", "item_ids", "spans")


def words_of(text: bytes) -> list[bytes]:
    """Runs of digits, letters and non-ASCII characters, with A-Z as a-z."""
    return text.translate(_TO_WORDS).split()


def _pieces(items: DataFrame, window: int) -> DataFrame:
    """(item, words, whole): items with words, cut where they are very long; each once."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("item").to_pylist()
            for item, text in zip(ids, batch.column("text").cast(pa.binary()), strict=True):
                found = words_of(text.as_py() or b"")
                step = PIECE_WORDS - window + 1
                starts = range(0, max(1, len(found) - window + 1), step) if found else ()
                parts = [found[i : i + PIECE_WORDS] for i in starts]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([item] * len(parts), pa.string()),
                        pa.array([b" ".join(p) for p in parts], pa.binary()),
                        pa.array([len(p) for p in parts], pa.int64()),
                        pa.array([len(found) < window] * len(parts), pa.bool_()),
                    ],
                    names=["item", "words", "n", "whole"],
                )

    named = items.select(F.col("item_id").cast("string").alias("item"), "text")
    return named.mapInArrow(cut, "item string, words binary, n bigint, whole boolean").distinct()


def matches(docs: DataFrame, items: DataFrame, *, window: int = WINDOW) -> DataFrame:
    """`docs` with n_words, n_hit, item_ids and spans.

    spans are ranges (start, end) of word positions inside any occurrence of a window,
    n_hit their words, item_ids the distinct ids, sorted as strings, of items with a window
    that occurs.  Windows are runs of `window` words of an item, or all words of a
    shorter one.

    A null or empty text has no words.  An item without words matches nothing; one without an
    id is matched but named nowhere.  Equal items count once, and an id on several items
    stands for all of them.  Every row is judged by itself, so repeated rows and
    ids do no harm.  Other columns pass through, added names replace existing ones.

    The documents are read once and not shuffled.  Items stand in automata of at most about
    BLOCK_WORDS words, sent to the executors one at a time; where there are more, the
    documents pass all of them, one after the other, by way of the shared folder.
    """
    scratch = Scratch(docs.sparkSession, "items")
    pieces = scratch.write(_pieces(items, window))
    total = pieces.agg(F.sum("n")).first()[0] or 0
    blocks = max(1, math.ceil(total / BLOCK_WORDS))
    block = F.pmod(F.xxhash64("item", "words"), F.lit(blocks))
    base = docs.drop(*_ADDED)
    none = F.array().cast("array<string>"), F.array().cast("array<struct<start:int,end:int>>")
    found = base.select(
        "*",
        F.lit(0).cast("bigint").alias("n_words"),
        none[0].alias("item_ids"),
        none[1].alias("spans"),
    )
    for i in range(blocks):
        if i:
            found = scratch.write(found)
        rows = pieces.filter(block == i).select("item", "words", "whole").collect()
        found = _pass(found, rows, window)
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["end"] - s["start"])
    return found.select(*base.columns, "n_words", n_hit.alias("n_hit"), "item_ids", "spans")


def _pass(docs: DataFrame, rows: list, window: int) -> DataFrame:
    """`docs` with the hits of one block of items added."""
    names = sorted({r["item"] for r in rows if r["item"] is not None})
    number = {name: i for i, name in enumerate(names)} | {None: -1}
    automaton = SuffixAutomaton(
        [(number[r["item"]], bytes(r["words"]).split(), r["whole"]) for r in rows], window
    )
    held = docs.sparkSession.sparkContext.broadcast((automaton, names))
    kept = [f.name for f in docs.schema if f.name not in ("n_words", "item_ids", "spans")]
    span = pa.struct([("start", pa.int32()), ("end", pa.int32())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, ids = held.value
        known = machine.words.get
        least = 1 if machine.any_short else window
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            items = batch.column("item_ids").to_pylist()
            spans = batch.column("spans").to_pylist()
            counts = []
            for k, text in enumerate(texts):
                word_ids = [known(w) for w in words_of(text or b"")]
                counts.append(len(word_ids))
                if len(word_ids) < least:
                    continue
                ranges, numbers = machine.hits(word_ids)
                if ranges:
                    before = [(s["start"], s["end"]) for s in spans[k]]
                    spans[k] = _union([*before, *ranges])
                    items[k] = sorted({*items[k], *(ids[n] for n in numbers if n >= 0)})
                    spans[k] = [{"start": s, "end": e} for s, e in spans[k]]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in kept],
                    pa.array(counts, pa.int64()),
                    pa.array(items, pa.list_(pa.string())),
                    pa.array(spans, pa.list_(span)),
                ],
                names=[*kept, "n_words", "item_ids", "spans"],
            )

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in kept]
    schema = ", ".join(
        [*fields, "n_words bigint, item_ids array<string>, spans array<struct<start:int,end:int>>"]
    )
    ordered = docs.select(*[f"`{c}`" for c in kept], "n_words", "item_ids", "spans")
    return ordered.mapInArrow(search, schema)


def _union(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], max(end, out[-1][1])
        else:
            out.append((start, end))
    return out


def without_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """`text` without the words of the spans and what stands between them."""
    at = [m.span() for m in _WORD.finditer(text)]
    out, last = [], 0
    for start, end in spans:
        out.append(text[last : at[start][0]])
        last = at[end - 1][1]
    return b"".join([*out, text[last:]])


def decontaminated(
    docs: DataFrame,
    items: DataFrame,
    *,
    window: int = WINDOW,
    shortest: int = 1,
    most_covered: float = 0.5,
) -> DataFrame:
    """`docs` without benchmark passages.

    Hit spans of `shortest` words or more are cut out of the text.  A document is removed if more than `most_covered` of its
    words are hit, or if no word is left after cutting.  All others stay unchanged.
    Nulls, repeats and further columns are as in `matches`.
    """
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    # Other columns travel as one, out of reach of the added names.
    rows = docs.select(F.struct(*others).alias("row"), "text")
    found = matches(rows, items, window=window)
    keep = (F.col("n_hit") == 0) | (F.col("n_hit") <= most_covered * F.col("n_words"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            kept = []
            for k, own in enumerate(batch.column("spans").to_pylist()):
                ranges = [
                    (s["start"], s["end"]) for s in own if s["end"] - s["start"] >= shortest
                ]
                if ranges:
                    texts[k] = without_spans(texts[k].encode(), ranges).decode()
                if not ranges or words_of(texts[k].encode()):
                    kept.append(k)
            out = pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(texts, pa.string())], names=["row", "text"]
            )
            yield out.take(pa.array(kept, pa.int64()))

    schema = f"row {rows.schema['row'].dataType.simpleString()}, text string"
    left = found.filter(keep).select("row", "text", "spans").mapInArrow(cut, schema)
    return left.select(
        *[F.col("text") if c == "text" else F.col(f"row.`{c}`") for c in docs.columns]
    )
