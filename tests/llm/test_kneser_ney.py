"""Perplexities against the formulas in plain Python."""

from __future__ import annotations

import glob
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm import kneser_ney
from llm.kneser_ney import discounts, quality_classified
from llm.scratch import Scratch


def _tokens(text, vocabulary):
    return ["<e>", *[w if w in vocabulary else "<u>" for w in text.lower().split()], "<e>"]


def _brute(train, texts):
    words = Counter(w for t in train for w in t.lower().split())
    vocabulary = {w for w, n in words.items() if n >= kneser_ney.LEAST_COUNT}
    types = len(words) - len(vocabulary)
    pairs = Counter()
    for t in train:
        own = _tokens(t, vocabulary)
        pairs.update(zip(own, own[1:], strict=False))
    d = (0, *discounts(Counter(pairs.values())))
    total, left, heads = Counter(), defaultdict(float), Counter()
    for (v, w), n in pairs.items():
        total[v] += n
        left[v] += d[min(n, 3)]
        heads[w] += 1
    low = (0, *discounts(Counter(heads.values())))
    rest = sum(low[min(n, 3)] for n in heads.values()) / sum(heads.values())
    size = len(vocabulary) + 2

    def p(v, w):
        lower = max(heads[w] - low[min(heads[w], 3)], 0) / sum(heads.values()) + rest / size
        n = pairs[v, w]
        share = left[v] / total[v] if total[v] else 1.0
        out = max(n - d[min(n, 3)], 0) / max(total[v], 1) + share * lower
        return out / (types + 1) if w == "<u>" else out

    if train:
        every = [*vocabulary, "<e>"]
        for v in ["<e>", *list(vocabulary)[:3]]:
            assert abs(sum(p(v, w) for w in every) + p(v, "<u>") * (types + 1) - 1) < 1e-9
    out = []
    for t in texts:
        own = _tokens(t, vocabulary)
        logs = [math.log10(p(v, w)) for v, w in zip(own, own[1:], strict=False)]
        out.append(10 ** (-sum(logs) / len(logs)))
    return out


@pytest.mark.parametrize(("held", "junk"), [(1 << 20, 0), (0, 0), (300, 0), (1 << 20, 50), (300, 50)])
def test_perplexities(spark, invented, monkeypatch, held, junk):
    """Whatever number of words the tasks hold, also beside languages of no use."""
    monkeypatch.setattr(kneser_ney, "SLICE_BYTES", 2000)
    monkeypatch.setattr(kneser_ney, "MOST_WORDS", held)
    monkeypatch.setattr(kneser_ney, "TEXT_OF_SHARDS", 3000)
    rng = random.Random(1)
    train = {"a": [invented(rng.randint(0, 80), k) for k in range(40)], "b": ["x y x y z z"] * 3}
    texts = [("a", invented(40, 7)), ("a", train["a"][3]), ("a", ""), ("b", "X y q"), ("b", "z " * 500)]
    rows = [(lang, t) for lang, own in train.items() for t in own]
    rows += [(f"junk{k}", "one two two") for k in range(junk)]
    scratch = Scratch(spark, "test")
    trained = kneser_ney.train(spark.createDataFrame(rows, "lang string, text string"), scratch)
    assert (trained.loose is None) == (held == 1 << 20)
    docs = spark.createDataFrame(
        [(bytes([k]), lang, t) for k, (lang, t) in enumerate(texts)] * 2,
        "key binary, lang string, text string",
    )
    scored = kneser_ney.perplexities(docs.repartition(3), trained)
    got = {r.key[0]: r.perplexity for r in scored.collect()}
    for lang in train:
        at = [k for k, (own, _) in enumerate(texts) if own == lang]
        for k, want in zip(at, _brute(train[lang], [texts[k][1] for k in at]), strict=True):
            assert got[k] == pytest.approx(want, rel=1e-9)


def _labelled(spark, invented):
    docs = [(k, invented(60, k), "en", "s", 1) for k in range(400)]
    docs += [(1000 + k, "%%% ".join(invented(40, k).split()), "en", "s", 1) for k in range(10)]
    labels = [(k, 1, 0) for k in range(0, 400, 2)] + [(1000, 0, 0), (None, 1, 0), (4, None, None), (0, 1, 1)]
    return docs, spark.createDataFrame(labels * 2, "doc_id bigint, quality int, toxic int")


def test_junk_goes_and_clean_text_stays(spark, make_docs, invented):
    docs, labels = _labelled(spark, invented)
    kept = {r.doc_id: r.kept for r in quality_classified(make_docs(docs), labels).collect()}
    assert sum(kept[k] for k in range(400)) > 390
    assert not any(kept[1000 + k] for k in range(10))


def test_edges(spark, edges):
    labels = spark.createDataFrame([(1, 1, 0), (6, 1, None)], "doc_id bigint, quality int, toxic int")
    for known in (labels, labels.limit(0)):
        found = quality_classified(edges.withColumn("kept", F.lit("x")), known)
        rows = found.collect()
        assert len(rows) == edges.count() and found.columns.count("kept") == 1
        for r in rows:
            if r.text is None:
                assert not r.kept and r.perplexity is None
            elif r.lang is None or known.count() == 0:
                assert r.kept and r.perplexity is None and r.threshold is None
    assert quality_classified(edges.limit(0), labels).count() == 0


def test_rooms_of_languages(monkeypatch):
    monkeypatch.setattr(kneser_ney, "MOST_WORDS", 100)
    assert kneser_ney._rooms({}) == {}
    assert kneser_ney._rooms({"a": 500, "b": 3, "c": 0, "d": 60}) == {"a": 49, "b": 3, "c": 0, "d": 48}


def test_bigrams_are_moved_small_and_whole():
    rng = np.random.default_rng(5)
    size = 1 << kneser_ney.WORD_BITS
    context, word = rng.integers(0, size, (2, 5000))
    shard, key = kneser_ney._key(context, word)
    for s in range(1 << kneser_ney.SHARD_BITS):
        at = shard == s
        got = kneser_ney._words(s, key[at])
        assert (got[0] == context[at]).all() and (got[1] == word[at]).all()
    for values in (key, np.zeros(0, np.uint32), np.array([2**32 - 1, 0], np.uint32)):
        assert (kneser_ney._unsqueezed(kneser_ney._squeezed(values)) == values).all()
    for keys in (key, np.sort(key), key[:0]):
        assert (kneser_ney._unsqueezed_keys(kneser_ney._squeezed_keys(keys)) == keys).all()
    # Frequent words have small numbers: their bigrams take less than their 4 bytes.
    rank = np.minimum(rng.zipf(1.3, (2, 20_000)), size - 1)
    assert len(kneser_ney._squeezed(kneser_ney._key(*rank)[1])) < 2.5 * 20_000


def test_frequent_words_have_small_numbers_and_only_one_bigram_table_stays(
    spark, monkeypatch
):
    monkeypatch.setattr(kneser_ney, "MOST_WORDS", 2)
    scratch = Scratch(spark, "test")
    texts = spark.createDataFrame(
        [("a", "z z z y y x x w v q"), ("a", "z y x q")], "lang string, text string"
    )
    trained = kneser_ney.train(texts, scratch)
    assert trained.models["a"].ids.min() == 2 and trained.loose is not None
    written = [p for p in glob.glob(f"{scratch.path}/*") if "context" in spark.read.parquet(p).columns]
    assert len(written) == 1
    rows = trained.bigrams.collect()
    assert len({(r.context, r.word) for r in rows}) == len(rows) and sum(r.n for r in rows) == 16


def test_last_join_moves_no_text(spark, make_docs, invented):
    docs, labels = _labelled(spark, invented)
    found = quality_classified(make_docs(docs).select("doc_id", "lang", "text"), labels)
    plan = found.select("doc_id", "kept")._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() != "Join":
        plan = plan.children().head()
    moved = plan.children().head().output().mkString(" ").split()
    assert "_no_text" in [c.split("#")[0] for c in moved]
    assert "text" not in [c.split("#")[0] for c in moved]
