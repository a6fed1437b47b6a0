"""Window hits against a search of every window at every place."""

from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from llm import decontaminate
from llm.automaton import SuffixAutomaton
from llm.decontaminate import decontaminated, matches


def _words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)


def _brute(docs, items, window):
    windows = {}
    for item, text in items:
        w = _words(text)
        for i in range(max(len(w) - window, 0) + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + window]), set()).add(item)
    out = []
    for doc_id, text in docs:
        w, hit, found = _words(text), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[tuple(w[i : i + n])]
        out.append((doc_id, len(w), len(hit), tuple(sorted(str(x) for x in found if x is not None))))
    return sorted(out, key=str)


def _got(found):
    rows = found.select("doc_id", "n_words", "n_hit", "item_ids").collect()
    return sorted(((*r[:3], tuple(r[3])) for r in rows), key=str)


def _cases(invented):
    rng = random.Random(4)
    items = [(i, invented(rng.choice([3, 9, 10, 11, 40]), 50 + i)) for i in range(20)]
    items += [(3, items[3][1]), (None, invented(12, 90)), (30, None), (31, " - "), (32, "Ünï 水")]
    docs = []
    for d in range(40):
        text = invented(rng.randint(0, 60), 500 + d)
        for _, passage in rng.sample(items[:22], 2):
            words = (passage or "").split()
            cut = words[rng.randrange(4) : len(words) - rng.randrange(4)]
            text += rng.choice([" ", "\n", ""]) + " ".join(cut).upper() + " tail"
        docs.append((d, text))
    docs += [(0, docs[0][1]), (0, "ünï 水 Ünï - 水"), (None, items[0][1]), (99, None), (98, "")]
    return docs, items


def test_hits(spark, make_docs, invented, monkeypatch):
    docs, items = _cases(invented)
    table = spark.createDataFrame(items, "item_id int, text string")
    want = _brute(docs, items, 10)
    assert _got(matches(make_docs(docs), table)) == want
    # Many automata, and items cut to pieces.
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 60)
    monkeypatch.setattr(decontaminate, "PIECE_WORDS", 15)
    assert _got(matches(make_docs(docs), table)) == want


def test_automaton_over_few_words():
    rng = random.Random(1)
    for _ in range(500):
        window, letters = rng.choice([2, 3, 4]), rng.choice([2, 3])
        items = [bytes(rng.choices(b"abc"[:letters], k=rng.randint(1, 8))) for _ in range(4)]
        doc = bytes(rng.choices(b"abcd"[: letters + 1], k=rng.randint(0, 30)))
        split = [[x[i : i + 1] for i in range(len(x))] for x in items]
        machine = SuffixAutomaton([(i, w, len(w) < window) for i, w in enumerate(split)], window)
        spans, seen = machine.hits([machine.words.get(doc[i : i + 1]) for i in range(len(doc))])
        hit, found = set(), set()
        for number, x in enumerate(items):
            for i in range(max(len(x) - window, 0) + 1):
                part = x[i : i + window]
                for at in range(len(doc)):
                    if doc.startswith(part, at):
                        hit |= set(range(at, at + len(part)))
                        found.add(number)
        assert {i for s, e in spans for i in range(s, e)} == hit and seen == found


def test_passages_are_cut_out(spark, make_docs, invented):
    passage, own = invented(20, 1), invented(60, 2)
    items = spark.createDataFrame([("a", passage)], "item_id string, text string")
    docs = make_docs([(1, f"{own} {passage} {own}"), (2, passage + " x"), (3, own), (4, None)])
    docs = docs.withColumn("spans", F.lit("mine")).withColumn("n_hit", F.col("doc_id"))
    left = {r.doc_id: r for r in decontaminated(docs, items).collect()}
    assert set(left) == {1, 3, 4} and left[3].text == own and left[4].text is None
    assert _words(left[1].text) == _words(own) * 2
    assert left[1].spans == "mine" and left[1].n_hit == 1


def test_empty_tables(spark, edges):
    items = spark.createDataFrame([], "item_id int, text string")
    assert {r.n_hit for r in matches(edges, items).collect()} == {0}
    assert matches(edges.limit(0), items).count() == 0
