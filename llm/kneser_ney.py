"""Interpolated modified Kneser-Ney bigrams, with counts in shards."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.carrying import carrying
from llm.lines import small
from llm.scratch import Scratch
from llm.shipping import ship
from llm.shingles import word_runs

_U = np.uint64
# Words that every task holds, the most frequent ones of each language; all languages share
# MOST_WORDS.  All other words are looked up by joins.
WORD_BITS = 18
MOST_WORDS = 1 << 20
# The rarest words of the trusted text are unknown words, so that these have a probability.
LEAST_COUNT = 2
# Pieces of a language's bigram table; a power of two that leaves 32 bits for the rest.
SHARD_BITS = 4
SLICE_BYTES = 4 << 20
# Text whose bigrams one task takes up in a shard; more text makes copies of the language's shards.
TEXT_OF_SHARDS = 32 << 30
# Marks the hash of a word that is not held; held words have numbers from 0 on.
_LOOSE = -(1 << 63)
# Bits of the filter that tells which words cannot be known beyond those held.
FILTER_BITS = 1 << 25
# A shard's bigrams are counted in so many pieces, by bits of their words.
_PIECE_BITS = 2
_ROWS_OUT = 200_000
UNKNOWN, EDGE = 0, 1
_FIRST = 2


@dataclass
class Language:
    """What scoring needs of one language besides the bigram counts; bounded by the words held."""

    words: np.ndarray  # sorted hashes
    ids: np.ndarray
    lower: np.ndarray  # log-free probability of each word by continuation
    share: np.ndarray  # what a context leaves to the lower order
    total: np.ndarray  # count of a context
    discounts: tuple[float, float, float]
    unknown_types: int
    partial: bool  # whether the vocabulary has further words
    filter: np.ndarray | None = None  # bits of these words' hashes, shared by all languages

    def tokens(self, hashes: np.ndarray) -> np.ndarray:
        """Words between two edges: numbers of held ones, negative marked hashes of words that may
        be known beyond them."""
        out = np.full(len(hashes) + 2, UNKNOWN, dtype=np.int64)
        if self.partial:
            codes = hashes.view(np.int64) | _LOOSE
            at = codes & (FILTER_BITS - 1)
            maybe = self.filter[at >> 3] >> (at & 7).astype(np.uint8) & 1
            out[1:-1] = np.where(maybe == 1, codes, UNKNOWN)
        out[0] = out[-1] = EDGE
        if len(self.words) and len(hashes):
            at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
            known = self.words[at] == hashes
            out[1:-1][known] = self.ids[at[known]]
        return out

    def log10(self, context: np.ndarray, word: np.ndarray, count: np.ndarray) -> np.ndarray:
        """log10 P(word | context), where the bigrams were counted `count` times.

        The probability of unknown words is spread over as many as were seen.
        """
        d = np.array([0.0, *self.discounts])[np.minimum(count, 3)]
        seen = np.maximum(count - d, 0) / np.maximum(self.total[context], 1)
        p = seen + self.share[context] * self.lower[word]
        return np.log10(p) - np.where(word == UNKNOWN, math.log10(self.unknown_types + 1), 0.0)


def discounts(counts_of_counts: dict[int, int]) -> tuple[float, float, float]:
    """Chen and Goodman's discounts for counts 1, 2, and 3 or more."""
    n = [counts_of_counts.get(k, 0) for k in range(5)]
    y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5
    out = []
    for k in (1, 2, 3):
        d = k - (k + 1) * y * n[k + 1] / n[k] if n[k] else k * y
        out.append(min(max(d, 0.0), float(k)))
    return tuple(out)


def _key(context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shard and 32-bit rest of a bigram; the pair tells bigrams apart, see `_words`.

    The shard depends on both words, so that a frequent context lies in all shards.
    """
    shard = (context + word * 40503) & ((1 << SHARD_BITS) - 1)
    return shard, ((context >> SHARD_BITS) << WORD_BITS | word).astype(np.uint32)


def _words(shard: int, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Context and word of `_key`."""
    wide = key.astype(np.int64)
    word = wide & ((1 << WORD_BITS) - 1)
    low = (shard - word * 40503) & ((1 << SHARD_BITS) - 1)
    return (wide >> WORD_BITS) << SHARD_BITS | low, word


def _squeezed(values: np.ndarray) -> bytes:
    """32-bit numbers, all first bytes before all second ones, which are mostly 0, compressed."""
    planes = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    packed = pa.Codec("zstd", compression_level=1).compress(planes.tobytes(), asbytes=True)
    return len(values).to_bytes(4, "little") + packed


def _squeezed_keys(keys: np.ndarray) -> bytes:
    """Keys of `_key`, mostly in order of context, by the differences of their contexts."""
    context = (keys >> np.uint32(WORD_BITS)).astype(np.int64)
    step = np.diff(context, prepend=0) & ((1 << (32 - WORD_BITS)) - 1)
    word = keys & np.uint32((1 << WORD_BITS) - 1)
    return _squeezed(step.astype(np.uint32) << np.uint32(WORD_BITS) | word)


def _unsqueezed_keys(data: bytes) -> np.ndarray:
    coded = _unsqueezed(data)
    # Sums modulo 2**32 keep their low bits; the shift drops the others.
    context = np.cumsum(coded >> np.uint32(WORD_BITS), dtype=np.uint32)
    return context << np.uint32(WORD_BITS) | coded & np.uint32((1 << WORD_BITS) - 1)


def _unsqueezed(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:4], "little")
    planes = pa.Codec("zstd").decompress(data[4:], decompressed_size=4 * n, asbytes=True)
    flat = np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, n).T)
    return flat.view("<u4").ravel()


def _batches(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    step = max(1, int(batch.num_rows * SLICE_BYTES / max(batch.nbytes, 1)))
    for i in range(0, batch.num_rows, step):
        yield batch.slice(i, step)


def _hashes(part: pa.RecordBatch) -> list[np.ndarray]:
    texts = part.column("text").cast(pa.binary()).to_pylist()
    return list(word_runs([t or b"" for t in texts], True))


def _word_counts(texts: DataFrame) -> DataFrame:
    """(lang, word, n) of `texts` (lang, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _batches(batch):
                langs = np.array(part.column("lang").to_pylist(), dtype=object)
                hashes = _hashes(part)
                for lang in dict.fromkeys(langs):
                    own = [hashes[i] for i in np.flatnonzero(langs == lang)]
                    word, n = np.unique(np.concatenate(own), return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(word), pa.string()), word.view(np.int64), n],
                        names=["lang", "word", "n"],
                    )

    counted = texts.mapInArrow(run, "lang string, word bigint, n bigint")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


@dataclass
class Trained:
    """Models by language, all bigram counts, and the words that the models do not hold.

    loose (lang, code, lower, total, share) has what a Language has of its words; None if
    every word is held.
    """

    models: dict[str, Language]
    bigrams: DataFrame
    loose: DataFrame | None


def _by_language(values: dict[str, float]) -> Column:
    out = F.lit(None).cast("double")
    for lang, value in values.items():
        out = F.when(F.col("lang") == lang, float(value)).otherwise(out)
    return out


def _rooms(words: dict[str, int]) -> dict[str, int]:
    """How many of its `words` each language may hold; small ones leave their room to others."""
    out, left = {}, MOST_WORDS
    for i, lang in enumerate(sorted(words, key=words.get)):
        share = min(left // (len(words) - i), (1 << WORD_BITS) - _FIRST)
        out[lang] = min(words[lang], share)
        left -= out[lang]
    return out


def _vocabularies(
    texts: DataFrame, scratch: Scratch
) -> tuple[dict[str, Language], DataFrame | None]:
    """Languages with the hashes of the words they hold, and (lang, code) of all other words.

    The vocabulary is every word counted LEAST_COUNT times.  Words are held from the most frequent
    count on as long as all of a count fit in.
    """
    counts = scratch.write(_word_counts(texts))
    capped = F.least("n", F.lit(1_000_000)).alias("n")
    sizes: dict[str, dict[int, int]] = {}
    for r in counts.select("lang", capped).groupBy("lang", "n").count().collect():
        sizes.setdefault(r["lang"], {})[r["n"]] = r["count"]
    room = _rooms({k: sum(m for n, m in of.items() if n >= LEAST_COUNT) for k, of in sizes.items()})
    least, partial = {}, {}
    for lang, of in sizes.items():
        taken, limit, most = 0, 1 << 62, room[lang]
        known = [n for n in sorted(of, reverse=True) if n >= LEAST_COUNT]
        for n in known:
            if taken + of[n] > most:
                break
            taken, limit = taken + of[n], n
        least[lang], partial[lang] = limit, taken < sum(of[n] for n in known)
    keep = F.lit(False)
    for lang, limit in least.items():
        keep = keep | ((F.col("lang") == lang) & (F.col("n") >= limit))
    words: dict[str, list[tuple[int, int]]] = {lang: [] for lang in sizes}
    for r in counts.filter(keep).select("lang", "word", capped).toLocalIterator():
        words[r["lang"]].append((r["word"], r["n"]))
    out, none = {}, np.zeros(0)
    for lang, found in words.items():
        own, often = np.array(found, dtype=np.int64).reshape(-1, 2).T
        own = np.ascontiguousarray(own).view(_U)
        order = np.argsort(own)
        sorted_ = own[order]
        # Frequent words have small numbers, which take less room where bigrams are moved.
        ids = np.empty(len(own), dtype=np.int64)
        ids[np.lexsort((sorted_, -often[order]))] = np.arange(_FIRST, _FIRST + len(own))
        unknown = sum(k for n, k in sizes[lang].items() if n < LEAST_COUNT)
        out[lang] = Language(
            sorted_, ids, none, none, none, (0.5, 1.0, 1.5), unknown, partial[lang]
        )
    if not any(partial.values()):
        scratch.drop(counts)
        return out, None
    code = F.col("word").bitwiseOR(F.lit(_LOOSE)).alias("code")
    loose = scratch.write(
        counts.filter(~keep & (F.col("n") >= LEAST_COUNT)).select("lang", code).distinct()
    )
    scratch.drop(counts)
    bits = _filter(loose)
    for model in out.values():
        model.filter = bits
    return out, loose


def _filter(loose: DataFrame) -> np.ndarray:
    """A bit for each code's low bits, of FILTER_BITS in all whatever the number of words.

    A word without its bit is unknown for certain; all others are joined, so that a full filter
    costs time and nothing else.
    """
    place = F.col("code").bitwiseAND(F.lit(FILTER_BITS - 1)) + 1
    parts = loose.groupBy(F.bitmap_bucket_number(place).alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
    )
    out = np.zeros(FILTER_BITS >> 3, dtype=np.uint8)
    for r in parts.toLocalIterator():
        own = np.frombuffer(r["bits"], np.uint8)
        at = (r["part"] - 1) * len(own)
        out[at : at + len(own)] = own[: len(out) - at]
    return out


def _known(rows: DataFrame, loose: DataFrame, side: str) -> DataFrame:
    """`rows` with words in `side` that the vocabulary does not have made unknown.

    Only rows without a number are joined, so that no frequent word is a key of the join.
    """
    known = loose.select("lang", F.col("code").alias(side), F.lit(True).alias("known"))
    found = rows.filter(F.col(side) < 0).join(known, ["lang", side], "left")
    word = F.when(F.col("known"), F.col(side)).otherwise(F.lit(UNKNOWN).cast("bigint"))
    found = found.withColumn(side, word).drop("known")
    return rows.filter(F.col(side) >= 0).unionByName(found)


def _bigrams(
    texts: DataFrame, models: dict[str, Language], loose: DataFrame | None, scratch: Scratch
) -> DataFrame:
    """(lang, context, word, n) of `texts`, with numbers of held words and codes of others."""
    held = texts.sparkSession.sparkContext.broadcast(models)

    def counted(
        batches: Iterator[pa.RecordBatch], full: bool
    ) -> Iterator[tuple[str, tuple[np.ndarray, ...]]]:
        """Language by language, a slice's bigrams of held words, or all others."""
        for batch in batches:
            for part in _batches(batch):
                langs = np.array(part.column("lang").to_pylist(), dtype=object)
                hashes = _hashes(part)
                for lang in dict.fromkeys(langs):
                    model = held.value[lang]
                    if not full and not model.partial:
                        continue
                    own = [model.tokens(hashes[i]) for i in np.flatnonzero(langs == lang)]
                    context = np.concatenate([t[:-1] for t in own])
                    word = np.concatenate([t[1:] for t in own])
                    at = ((context >= 0) & (word >= 0)) == full
                    yield lang, _counted(context[at], word[at])

    def packets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, (context, word, n) in counted(batches, True):
            if not len(n):
                continue
            shard, key = _key(context, word)
            piece = shard << _PIECE_BITS | word & ((1 << _PIECE_BITS) - 1)
            order = np.lexsort((key, piece))
            key, n = key[order], n[order]
            own, first = np.unique(piece[order], return_index=True)
            ends = np.r_[first[1:], len(key)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(own), pa.string()),
                    pa.array(own, pa.int32()),
                    *[
                        pa.array(
                            [packed(x[i:j]) for i, j in zip(first, ends, strict=True)], pa.binary()
                        )
                        for x, packed in ((key, _squeezed_keys), (n, _squeezed))
                    ],
                ],
                names=["lang", "piece", "keys", "counts"],
            )

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, keys, counts = None, [], []

        def whole() -> Iterator[pa.RecordBatch]:
            if at is None:
                return
            key, place = np.unique(np.concatenate(keys), return_inverse=True)
            n = np.bincount(place, np.concatenate(counts), len(key)).astype(np.int64)
            for i in range(0, len(key), _ROWS_OUT):
                context, word = _words(at[1] >> _PIECE_BITS, key[i : i + _ROWS_OUT])
                lang = pa.array([at[0]] * len(word), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [lang, context, word, n[i : i + _ROWS_OUT]],
                    names=["lang", "context", "word", "n"],
                )

        for batch in batches:
            for lang, piece, k, c in zip(*[x.to_pylist() for x in batch.columns], strict=True):
                if (lang, piece) != at:
                    yield from whole()
                    at, keys, counts = (lang, piece), [], []
                keys.append(_unsqueezed_keys(k))
                counts.append(_unsqueezed(c))
        yield from whole()

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, columns in counted(batches, False):
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(columns[2]), pa.string()), *columns],
                names=["lang", "context", "word", "n"],
            )

    rows = "lang string, context bigint, word bigint, n bigint"
    sent = texts.mapInArrow(packets, "lang string, piece int, keys binary, counts binary")
    dealt = sent.repartition("lang", "piece").sortWithinPartitions("lang", "piece")
    out = dealt.mapInArrow(summed, rows)
    if loose is None:
        return scratch.write(out)
    total = F.sum("n").alias("n")
    rest = texts.mapInArrow(others, rows).groupBy("lang", "context", "word").agg(total)
    out = scratch.write(out.unionByName(rest))
    # Only bigrams with a word that is or becomes unknown can meet others; those of held words
    # are counted already.
    sure = (F.col("context") > UNKNOWN) & (F.col("word") > UNKNOWN)
    found = _known(_known(out.filter(~sure), loose, "context"), loose, "word")
    again = found.groupBy("lang", "context", "word").agg(total)
    whole = scratch.write(out.filter(sure).unionByName(again))
    scratch.drop(out)
    return whole


def _counted(context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct bigrams and how often each stands there."""
    held = (context >= 0) & (word >= 0)
    key, n = np.unique(context[held] << WORD_BITS | word[held], return_counts=True)
    out = key >> WORD_BITS, key & ((1 << WORD_BITS) - 1), n
    if held.all():
        return out
    rest, m = np.unique(
        np.stack([context[~held], word[~held]]), axis=1, return_counts=True
    )
    return tuple(np.concatenate(c) for c in zip(out, (*rest, m), strict=True))


def train(texts: DataFrame, scratch: Scratch) -> Trained:
    """Models of `texts` (lang, text without nulls).

    All text is counted by the executors.  The driver holds what belongs to at most MOST_WORDS
    words; the others stay in tables, so that the vocabulary has no bound.
    """
    models, loose = _vocabularies(texts, scratch)
    bigrams = _bigrams(texts, models, loose, scratch)
    kinds: dict[str, dict[int, int]] = {}
    for r in bigrams.filter("n <= 4").groupBy("lang", "n").count().collect():
        kinds.setdefault(r["lang"], {})[r["n"]] = r["count"]
    for lang, model in models.items():
        model.discounts = discounts(kinds.get(lang, {}))
        size = len(model.words) + _FIRST
        model.share, model.total = np.ones(size), np.zeros(size)
        model.lower = np.zeros(size)
    classes = [F.count(F.when(F.col("n") == k, 1)).alias(f"n{k}") for k in (1, 2)]
    contexts = bigrams.groupBy("lang", "context").agg(
        F.sum("n").alias("n"), *classes, F.count(F.when(F.col("n") > 2, 1)).alias("n3")
    )
    for r in contexts.filter("context >= 0").toLocalIterator():
        model = models[r["lang"]]
        d = model.discounts
        model.total[r["context"]] = r["n"]
        model.share[r["context"]] = (d[0] * r["n1"] + d[1] * r["n2"] + d[2] * r["n3"]) / r["n"]
    heads = bigrams.groupBy("lang", "word").agg(F.count("*").alias("n"))
    for r in heads.filter("word >= 0").toLocalIterator():
        models[r["lang"]].lower[r["word"]] = r["n"]
    # How many words follow 1, 2, 3, 4 or more contexts, and how many contexts these are.
    beyond: dict[str, dict[int, tuple[int, int]]] = {}
    if loose is not None:
        classed = heads.filter("word < 0").groupBy("lang", F.least("n", F.lit(5)).alias("k"))
        for r in classed.agg(F.count("*").alias("words"), F.sum("n").alias("n")).collect():
            beyond.setdefault(r["lang"], {})[r["k"]] = r["words"], r["n"]
    lower: dict[str, tuple] = {}
    for lang, model in models.items():
        # The same discounting over the numbers of contexts a word follows; what is left is
        # spread evenly, so that no word is impossible.
        n, more = model.lower, beyond.get(lang, {})
        kinds_of = {k: int((n == k).sum()) + more.get(k, (0, 0))[0] for k in range(1, 5)}
        d = np.array([0.0, *discounts(kinds_of)])
        total = n.sum() + sum(m for _, m in more.values())
        left = d[np.minimum(n, 3).astype(int)].sum()
        left += sum(d[min(k, 3)] * words for k, (words, _) in more.items())
        size = len(n) + sum(words for words, _ in more.values())
        even = (left / total if total else 1.0) / size
        model.lower = np.maximum(n - d[np.minimum(n, 3).astype(int)], 0) / max(total, 1) + even
        lower[lang] = *d[1:], max(total, 1), even
    if loose is None:
        return Trained(models, bigrams, None)
    some = [lang for lang, model in models.items() if model.partial]

    def constant(i: int, of: dict[str, tuple]) -> Column:
        return _by_language({lang: of[lang][i] for lang in some})

    def discounted(n: str, of: dict[str, tuple]) -> Column:
        return F.when(F.col(n) == 1, constant(0, of)).when(
            F.col(n) == 2, constant(1, of)
        ).otherwise(constant(2, of))

    of_word = heads.filter("word < 0").select(
        "lang",
        F.col("word").alias("code"),
        (F.greatest(F.col("n") - discounted("n", lower), F.lit(0.0)) / constant(3, lower)
         + constant(4, lower)).alias("lower"),
    )
    own = {lang: models[lang].discounts for lang in some}
    of_context = contexts.filter("context < 0").select(
        "lang",
        F.col("context").alias("code"),
        F.col("n").cast("double").alias("total"),
        (
            sum(constant(i, own) * F.col(f"n{i + 1}") for i in range(3)) / F.col("n")
        ).alias("share"),
    )
    return Trained(models, bigrams, scratch.write(of_word.join(of_context, ["lang", "code"])))


def _packed_model(bigrams: DataFrame, langs: list[str], copies: dict[str, int]) -> DataFrame:
    """(shard, copy, kind 0, data): the counts of bigrams of held words, in pieces."""
    number = F.lit(-1)
    for i, lang in enumerate(langs):
        number = F.when(F.col("lang") == lang, i).otherwise(number)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, context, word, n = (
                batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64)
                for c in ("lang", "context", "word", "n")
            )
            shard, key = _key(context, word)
            shard = lang << SHARD_BITS | shard
            order = np.lexsort((key, shard))
            shard, key, n = shard[order], key[order], np.minimum(n[order], 2**31)
            data = [
                (s, key[shard == s], n[shard == s].astype(np.uint32))
                for s in np.unique(shard).tolist()
            ]
            yield _payload(
                [
                    (s, i, 0, None, _squeezed_keys(k), _squeezed(c), None, None, None)
                    for s, k, c in data
                    for i in range(copies[langs[s >> SHARD_BITS]])
                ]
            )

    rows = bigrams.filter("context >= 0 and word >= 0")
    return rows.select(number.alias("lang"), "context", "word", "n").mapInArrow(run, _PAYLOAD)


# docs: how many keys each document has; at: the documents' numbers beyond `first`.
_PAYLOAD = (
    "shard int, copy int, kind int, first bigint, keys binary, counts binary, docs binary, "
    "at binary, names array<binary>"
)


def _payload(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * 9
    return pa.RecordBatch.from_arrays(
        [
            *[pa.array(c, pa.int32()) for c in columns[:3]],
            pa.array(columns[3], pa.int64()),
            *[pa.array(c, pa.binary()) for c in columns[4:8]],
            pa.array(columns[8], pa.list_(pa.binary())),
        ],
        names=[f.split()[0] for f in _PAYLOAD.split(", ")],
    )


def _queries(
    docs: DataFrame, models: dict[str, Language], langs: list[str], copies: dict[str, int]
) -> DataFrame:
    """(shard, copy, kind 1, ...): the distinct bigrams of held words, with their documents.

    Documents have numbers, told with their keys in rows of kind 2, so that a key travels once.
    """
    held = docs.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        first = task << 33
        for batch in batches:
            for part in _batches(batch):
                lang = part.column("lang").to_pylist()
                keys = part.column("key").to_pylist()
                hashes = _hashes(part)
                out = []
                for number, name in enumerate(langs):
                    own = [i for i, x in enumerate(lang) if x == name]
                    if not own:
                        continue
                    tokens = [held.value[name].tokens(hashes[i]) for i in own]
                    pairs = [
                        np.unique(
                            (t[:-1] << WORD_BITS | t[1:])[(t[:-1] >= 0) & (t[1:] >= 0)],
                            return_counts=True,
                        )
                        for t in tokens
                    ]
                    pair = np.concatenate([p for p, _ in pairs])
                    n = np.concatenate([c for _, c in pairs])
                    doc = np.repeat(np.arange(len(own)), [len(p) for p, _ in pairs])
                    shard, key = _key(pair >> WORD_BITS, pair & ((1 << WORD_BITS) - 1))
                    place = np.array(own, dtype=np.int64)
                    some = number << SHARD_BITS | first & ((1 << SHARD_BITS) - 1)
                    names = [keys[i] for i in own]
                    copy = task % copies[name]
                    out.append(
                        (some, copy, 2, first, None, None, None, _squeezed(place), names)
                    )
                    for s in range(1 << SHARD_BITS):
                        at = np.flatnonzero(shard == s)
                        if len(at):
                            present, many = np.unique(doc[at], return_counts=True)
                            out.append(
                                (
                                    number << SHARD_BITS | s,
                                    copy,
                                    1,
                                    first,
                                    _squeezed_keys(key[at]),
                                    _squeezed(n[at]),
                                    _squeezed(many),
                                    _squeezed(place[present]),
                                    None,
                                )
                            )
                first += part.num_rows
                yield _payload(out)

    return docs.mapInArrow(run, _PAYLOAD)


def _loose_parts(docs: DataFrame, trained: Trained) -> DataFrame:
    """(key, log, n): the part of bigrams with a word that the models do not hold.

    Three joins of such bigrams only: both words with the loose words, and the bigram with its
    count.  Other than unknown words, no frequent word is a key, and the right sides have a key
    once, so that adaptive execution may split a large left one.
    """
    models = trained.models
    some = sorted(lang for lang, model in models.items() if model.partial)
    held = docs.sparkSession.sparkContext.broadcast({lang: models[lang] for lang in some})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _batches(batch):
                langs, keys = part.column("lang").to_pylist(), part.column("key").to_pylist()
                for lang, key, hashes in zip(langs, keys, _hashes(part), strict=True):
                    model = held.value[lang]
                    t = model.tokens(hashes)
                    open_ = (t[:-1] < 0) | (t[1:] < 0)
                    context, word, n = _counted(t[:-1][open_], t[1:][open_])
                    at, of = np.maximum(context, UNKNOWN), np.maximum(word, UNKNOWN)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([key] * len(n), pa.binary()),
                            pa.array([lang] * len(n), pa.string()),
                            *[pa.array(c) for c in (context, word, n)],
                            *[pa.array(c) for c in (model.total[at], model.share[at])],
                            pa.array(model.lower[of]),
                        ],
                        names=[f.split()[0] for f in _LOOSE_ROWS.split(", ")],
                    )

    rows = docs.filter(F.col("lang").isin(some)).mapInArrow(run, _LOOSE_ROWS)
    for side, values in (("context", ["total", "share"]), ("word", ["lower"])):
        found = trained.loose.select(
            "lang", F.col("code").alias(side), *[F.col(v).alias(f"own_{v}") for v in values]
        )
        known = F.col(f"own_{values[0]}").isNotNull()
        code = F.when((F.col(side) < 0) & ~known, F.lit(UNKNOWN).cast("bigint"))
        rows = rows.join(found, ["lang", side], "left").withColumns(
            {side: F.coalesce(code, F.col(side))}
            | {v: F.coalesce(f"own_{v}", v) for v in values}
        )
        rows = rows.drop(*[f"own_{v}" for v in values])
    counts = trained.bigrams.filter("context <= 0 or word <= 0").select(
        "lang", "context", "word", F.col("n").alias("count")
    )
    rows = rows.join(counts, ["lang", "context", "word"], "left")
    d = [_by_language({lang: models[lang].discounts[i] for lang in some}) for i in range(3)]
    seen = F.col("count") - F.when(F.col("count") == 1, d[0]).when(
        F.col("count") == 2, d[1]
    ).otherwise(d[2])
    seen = F.coalesce(F.greatest(seen, F.lit(0.0)), F.lit(0.0))
    p = seen / F.greatest("total", F.lit(1.0)) + F.col("share") * F.col("lower")
    types = _by_language({lang: math.log10(models[lang].unknown_types + 1) for lang in some})
    log = F.log10(p) - F.when(F.col("word") == UNKNOWN, types).otherwise(0.0)
    return rows.groupBy("key").agg(
        F.sum(log * F.col("n")).alias("log"), F.sum("n").cast("double").alias("n")
    )


_LOOSE_ROWS = (
    "key binary, lang string, context bigint, word bigint, n bigint, "
    "total double, share double, lower double"
)


def perplexities(docs: DataFrame, trained: Trained) -> DataFrame:
    """(key, perplexity) of `docs` (key binary, lang, text) in the model of their language.

    Bigram counts and the distinct bigrams of documents meet in shards by language and bigram.
    A shard's counts come first and are held; the documents' bigrams stream past.  The shards
    of a language with much text have copies, between which documents are dealt.  Only
    sums of each document and shard come out.  Bigrams of words that are not held are joined (see
    `_loose_parts`).  Rows of equal key add up in sum and number, and so do not change the perplexity.
    """
    spark = docs.sparkSession
    models = trained.models
    langs = sorted(models)
    held = spark.sparkContext.broadcast(models)
    texts = docs.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("n"))
    sizes = {r["lang"]: r["n"] for r in texts.collect()}
    copies = {lang: 1 + (sizes.get(lang) or 0) // TEXT_OF_SHARDS for lang in langs}
    shards = max(sum(copies.values()) << SHARD_BITS, 1)
    model_rows = _packed_model(trained.bigrams, langs, copies)
    both = model_rows.unionByName(_queries(docs, models, langs, copies))
    dealt = both.repartition(shards, "shard", "copy").sortWithinPartitions("shard", "copy", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, pieces, known, counts = None, [], None, None
        for batch in batches:
            rows, keyed, sums, numbers = [], [], [], []
            for i in range(batch.num_rows):
                shard, copy, kind, first, keys, n, doc, place, names = (
                    c[i].as_py() for c in batch.columns
                )
                if (shard, copy) != at:
                    at, pieces, known = (shard, copy), [], None
                if kind == 2:
                    rows.append(first + _unsqueezed(place).astype(np.int64))
                    keyed += names
                    sums.append(np.zeros(len(names)))
                    numbers.append(np.zeros(len(names)))
                    continue
                key, n = _unsqueezed_keys(keys), _unsqueezed(n)
                if kind == 0:
                    pieces.append((key, n))
                    continue
                if known is None:
                    known = np.concatenate([p[0] for p in pieces] or [np.zeros(0, np.uint32)])
                    counts = np.concatenate([p[1] for p in pieces] or [np.zeros(0, np.uint32)])
                    order = np.argsort(known)
                    known, counts, pieces = known[order], counts[order], []
                model = held.value[langs[shard >> SHARD_BITS]]
                count = np.zeros(len(key), dtype=np.int64)
                if len(known):
                    where = np.minimum(np.searchsorted(known, key), len(known) - 1)
                    same = known[where] == key
                    count[same] = counts[where[same]]
                context, word = _words(shard, key)
                many = _unsqueezed(doc)
                doc = np.repeat(np.arange(len(many)), many)
                log = model.log10(context, word, count) * n
                rows.append(first + _unsqueezed(place).astype(np.int64))
                keyed += [None] * len(many)
                sums.append(np.bincount(doc, log, len(many)))
                numbers.append(np.bincount(doc, n, len(many)))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(rows)),
                        pa.array(keyed, pa.binary()),
                        pa.array(np.concatenate(sums)),
                        pa.array(np.concatenate(numbers)),
                    ],
                    names=["id", "key", "log", "n"],
                )

    parts = dealt.mapInArrow(run, "id bigint, key binary, log double, n double")
    parts = parts.groupBy("id").agg(
        F.max("key").alias("key"), F.sum("log").alias("log"), F.sum("n").alias("n")
    )
    parts = parts.drop("id")
    if trained.loose is not None:
        parts = parts.unionByName(_loose_parts(docs, trained))
    total = parts.groupBy("key").agg(F.sum("log").alias("log"), F.sum("n").alias("n"))
    return total.select("key", F.pow(F.lit(10.0), -F.col("log") / F.col("n")).alias("perplexity"))


def _keyed(docs: DataFrame) -> DataFrame:
    """`docs` with a 128-bit `_key` of id, language and text."""
    parts = [F.col("doc_id").cast("string"), F.col("lang"), F.col("text")]
    flat = F.to_json(F.struct(*[p.isNull().alias(f"n{i}") for i, p in enumerate(parts)]))
    return docs.withColumn(
        "_key", F.unhex(F.md5(F.concat_ws("\x00", flat, *parts)))
    )


@carrying("perplexity", "threshold", "kept")
def quality_classified(
    docs: DataFrame,
    labels: DataFrame,
    *,
    quantile: float = 0.99,
    held_out_parts: int = 5,
) -> DataFrame:
    """`docs` with perplexity, threshold and kept.

    Trusted documents are those that some row of `labels` gives quality 1 and none toxic 1.
    A model per language is trained on all of them but a part of 1 in `held_out_parts`, drawn by a hash
    of the text; the `quantile` of the held-out ones' perplexities is the language's threshold.  A document is kept if its perplexity is not above that.

    Words are separated by white space, with A-Z as a-z.  A null text has a null perplexity and is
    not kept; one without words is scored as an empty sentence.  A null language, or one
    without trusted text, has no model: perplexity and threshold are null and the document is kept.  Rows of a
    doc_id that repeats are scored each by its text; a label counts for all of them, repeated
    labels once.  Null labels and a null doc_id say nothing.  Other columns pass through, existing ones of
    the added names are replaced.
    """
    ship(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "quality")
    base = docs.drop("perplexity", "threshold", "kept")
    trusted = scratch.write(
        labels.filter("doc_id is not null")
        .groupBy("doc_id")
        .agg(F.max("quality").alias("good"), F.max("toxic").alias("toxic"))
        .filter("good = 1 and coalesce(toxic, 0) <> 1")
        .select("doc_id")
    )
    usable = docs.filter("lang is not null and text is not null")
    held = F.pmod(F.xxhash64("text"), F.lit(held_out_parts)) == 0
    sample = usable.join(small(trusted, 2_000_000), "doc_id", "left_semi")
    trained = train(sample.filter(~held).select("lang", "text"), scratch)
    scored = scratch.write(
        perplexities(
            _keyed(usable.filter(F.col("lang").isin(sorted(trained.models)))).select(
                F.col("_key").alias("key"), "lang", "text"
            ),
            trained,
        )
    )
    reference = (
        _keyed(usable.filter(held).join(small(trusted, 2_000_000), "doc_id", "left_semi"))
        .select("_key", "lang")
        .join(scored, F.col("_key") == F.col("key"))
        .groupBy("lang")
        .agg(F.percentile_approx("perplexity", quantile, 10_000).alias("threshold"))
    )
    limits = {r["lang"]: r["threshold"] for r in reference.collect()}
    limit: Column = F.lit(None).cast("double")
    for lang, value in limits.items():
        limit = F.when(F.col("d.lang") == lang, value).otherwise(limit)
    # Told before the join, which so moves texts only for those who ask for them.
    return (
        _keyed(base)
        .withColumn("_no_text", F.col("text").isNull())
        .alias("d")
        .join(scored.alias("s"), F.col("d._key") == F.col("s.key"), "left")
        .select(
            *[F.col(f"d.`{c}`") for c in base.columns],
            "s.perplexity",
            limit.alias("threshold"),
            F.when(F.col("d._no_text"), False)
            .otherwise(F.coalesce(F.col("s.perplexity") <= limit, F.lit(True)))
            .alias("kept"),
        )
    )
