"""Language identification: known words first, then ever shorter character n-grams."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The classifier is fitted on about this many labelled documents of each language, chosen
# by a hash of their contents.
DOCUMENTS_PER_LANGUAGE = 4_000
# Entries of the model for each language: words, and n-grams of each length.  What other
# languages there are has no effect on them.
WORDS, GRAMS = 50_000, 10_000
LONGEST_GRAM = 5
# Cost (-log10 of the relative frequency) of what a language does not have.
PENALTY = 7.0
UNDETERMINED = "und"
# Scores of unknown words kept by a Python process.
_KEPT = 200_000
_WORD = re.compile(r"[^\W\d_]+")


def remainder(doc_id: Column, parts: int = 5) -> Column:
    """CRC-32 of an id as text modulo `parts`; a null id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(parts))


def words_of(text: str) -> list[str]:
    """Runs of letters in lower case."""
    return _WORD.findall(text.lower())


def grams_of(word: str, n: int) -> list[str]:
    """Character n-grams of a word with a space at both ends."""
    padded = f" {word} "
    return [padded[i : i + n] for i in range(len(padded) - n + 1)]


class Model:
    """Costs of words and n-grams in each language, scored by backing off."""

    def __init__(self, languages: list[str], words: dict, grams: list[dict]):
        """words and grams: text to a row of costs by language; grams by length from 1."""
        self.languages = languages
        self.row = {w: i for i, w in enumerate(words)}
        shape = len(words), len(languages)
        self.costs = np.array(list(words.values()), np.float64).reshape(shape)
        self.grams = grams
        self.unknown: dict[str, np.ndarray | None] = {}

    def backed_off(self, word: str) -> np.ndarray | None:
        """Mean costs of the longest n-grams that some language has, None if none has any."""
        for n in range(len(self.grams), 0, -1):
            known = [self.grams[n - 1][g] for g in grams_of(word, n) if g in self.grams[n - 1]]
            if known:
                return np.mean(known, axis=0)
        return None

    def score(self, text: str | None) -> tuple[str, float]:
        words = words_of(text or "")
        if not words or not self.languages:
            return UNDETERMINED, 0.0
        rows = [self.row.get(w, -1) for w in words]
        at = np.array(rows)
        total, n = self.costs[at[at >= 0]].sum(axis=0), int((at >= 0).sum())
        for w in (w for w, r in zip(words, rows, strict=True) if r < 0):
            if w not in self.unknown:
                if len(self.unknown) >= _KEPT:
                    self.unknown.clear()
                self.unknown[w] = self.backed_off(w)
            cost = self.unknown[w]
            if cost is not None:
                total, n = total + cost, n + 1
        mean = total / max(n, 1)
        best = int(mean.argmin())
        return self.languages[best], float(1 / (10.0 ** (mean[best] - mean)).sum())


def fit(
    docs: DataFrame, *, documents: int = DOCUMENTS_PER_LANGUAGE, words: int = WORDS
) -> Model:
    """A model of `docs` with text and lang; rows with nulls are left out.

    At most about `documents` rows of each language are used (see DOCUMENTS_PER_LANGUAGE).
    Words and n-grams are counted by the executors; the driver gets the most frequent ones,
    `words` and LONGEST_GRAM x GRAMS entries at most of each language.
    """
    labelled = docs.filter("text is not null and lang is not null").select(
        "text", F.col("lang").cast("string").alias("lang")
    )
    sizes = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    if not sizes:
        return Model([], {}, [])
    # Languages from the most frequent on: the first wins a tie.
    languages = sorted(sizes, key=lambda k: (-sizes[k], k))
    rate = F.lit(1.0)
    for name, n in sizes.items():
        rate = F.when(F.col("lang") == name, min(1.0, documents / n)).otherwise(rate)
    draw = F.pmod(F.xxhash64("text"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    sample = labelled.filter(draw < rate)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter = Counter()
            texts, langs = batch.column("text").to_pylist(), batch.column("lang").to_pylist()
            for text, lang in zip(texts, langs, strict=True):
                found.update((lang, w) for w in words_of(text))
            yield _counted([(*k, 0, n) for k, n in found.items()])

    def divide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter = Counter()
            columns = [batch.column(c).to_pylist() for c in ("lang", "gram", "n")]
            for lang, word, n in zip(*columns, strict=True):
                for size in range(1, LONGEST_GRAM + 1):
                    for g in grams_of(word, size):
                        found[lang, g, size] += n
            yield _counted([(*k, n) for k, n in found.items()])

    schema = "lang string, gram string, size int, n bigint"
    total = F.sum("n").alias("n")
    counts = sample.mapInArrow(count, schema).groupBy("lang", "gram", "size").agg(total).cache()
    grams = counts.select("lang", "gram", "n").mapInArrow(divide, schema)
    every = counts.unionByName(grams.groupBy("lang", "gram", "size").agg(total))
    share = Window.partitionBy("lang", "size")
    ranked = every.withColumns(
        {
            "all": F.sum("n").over(share),
            "rank": F.row_number().over(share.orderBy(F.desc("n"), "gram")),
        }
    )
    most = F.when(F.col("size") == 0, words).otherwise(GRAMS)
    rows = ranked.filter(F.col("rank") <= most).select("lang", "gram", "size", "n", "all").collect()
    counts.unpersist()
    number = {name: i for i, name in enumerate(languages)}
    tables: list[dict] = [{} for _ in range(LONGEST_GRAM + 1)]
    for r in rows:
        costs = tables[r["size"]].setdefault(r["gram"], [PENALTY] * len(languages))
        costs[number[r["lang"]]] = min(PENALTY, float(-np.log10(r["n"] / r["all"])))
    return Model(languages, tables[0], [{g: np.array(c) for g, c in t.items()} for t in tables[1:]])


def _counted(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * 4
    kinds = [pa.string(), pa.string(), pa.int32(), pa.int64()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
        names=["lang", "gram", "size", "n"],
    )


def predicted(docs: DataFrame, model: Model) -> DataFrame:
    """`docs` with lang_pred and score, from the text alone.

    A word that any language has costs each language -log10 of its relative frequency there,
    or PENALTY; any other word costs the mean over its longest n-grams that some language
    has.  The language of the least mean cost per word is predicted; score is 1 over the sum of
    10 ** (least cost - cost) over languages, the share of the prediction for an average word.

    A null text, or one without letters, is `und` with score 0, as is all if nothing was
    learned.  A text of which no language has any part goes to the most frequent language
    with a score of 1 over their number.  Rows are independent; other columns pass through, and
    existing columns of the added names are replaced.
    """
    base = docs.drop("lang_pred", "score")
    names = base.columns
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = held.value.score
        for batch in batches:
            found = [score(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array([f[0] for f in found], pa.string()),
                    pa.array([f[1] for f in found], pa.float64()),
                ],
                names=[*names, "lang_pred", "score"],
            )

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema]
    return base.mapInArrow(run, ", ".join([*fields, "lang_pred string, score double"]))
