"""Held-out accuracy, back-off by hand, and edges."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from llm import language
from llm.language import Model, fit, grams_of, predicted, remainder

SYLLABLES = {"en": "th er on an re he in ed".split(), "fi": "aa ki uu la ta nen sö yy".split()}


def _rows(n=240):
    rng = random.Random(6)
    rows = []
    for d in range(n):
        lang = rng.choice(["en", "en", "fi"])
        words = ["".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 4))) for _ in range(20)]
        rows.append((d, " ".join(words).title() + " 17!", lang, "s", 1))
    return rows


def test_held_out_accuracy(make_docs):
    docs = make_docs(_rows())
    held = remainder(F.col("doc_id")) == 0
    model = fit(docs.filter(~held))
    rows = predicted(docs.withColumn("held", held), model).collect()
    for r in rows:
        assert r.held == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    out = [r for r in rows if r.held]
    assert len(out) > 20 and all(r.lang == r.lang_pred and 0.5 < r.score <= 1 for r in out)


def test_model_is_the_counts(make_docs):
    rows = _rows(60)
    model = fit(make_docs(rows))
    for at, lang in enumerate(model.languages):
        words = Counter(w for r in rows if r[2] == lang for w in language.words_of(r[1]))
        total = sum(words.values())
        for w, n in words.items():
            assert abs(model.costs[model.row[w], at] + np.log10(n / total)) < 1e-9
        for size in (1, 3, 5):
            grams = Counter()
            for w, n in words.items():
                for g in grams_of(w, size):
                    grams[g] += n
            g, n = grams.most_common(1)[0]
            assert abs(model.grams[size - 1][g][at] + np.log10(n / sum(grams.values()))) < 1e-9


def test_backing_off():
    costs = {"ab": np.array([1.0, 4.0])}, {" x": np.array([5.0, 2.0])}
    model = Model(["p", "q"], {"known": [1.0, 3.0]}, [costs[0] | {"x": np.array([9.0, 9.0])}, costs[1]])
    assert model.score("known")[0] == "p" and model.score("xyz")[0] == "q"
    assert list(model.backed_off("xyz")) == [5.0, 2.0]
    assert model.backed_off("水") is None and model.score("水") == ("p", 0.5)
    assert model.score(" 12 .") == model.score(None) == ("und", 0.0)


def test_edges(edges):
    model = fit(edges)
    found = predicted(edges.withColumn("score", F.lit("x")), model)
    rows = found.collect()
    assert len(rows) == edges.count() and found.columns.count("score") == 1
    for r in rows:
        letters = any(c.isalpha() for c in r.text or "")
        assert r.lang_pred == ("en" if letters else "und") and 0 <= r.score <= 1
    nothing = fit(edges.limit(0))
    assert {r.lang_pred for r in predicted(edges, nothing).collect()} == {"und"}
    assert predicted(edges.limit(0), model).count() == 0


def test_other_languages_take_no_words_away(spark, invented):
    rows = [(invented(60, k), "a") for k in range(20)]
    junk = [("x", f"junk{k}") for k in range(50)]
    alone, beside = (
        fit(spark.createDataFrame(r, "text string, lang string"), words=400) for r in (rows, rows + junk)
    )
    at = beside.languages.index("a")
    for word, row in alone.row.items():
        assert beside.costs[beside.row[word]][at] == alone.costs[row][0]
