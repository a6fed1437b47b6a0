"""Near-duplicates against brute force over all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm import linking
from llm.components import components
from llm.minhash import Bands
from llm.near_dedup import near_duplicates
from llm.scratch import Scratch
from llm.shingles import shingle_sets
from tests.llm.conftest import Links, jaccard_links


def _set(text, size):
    words = (text or "").encode().lower().split()
    if len(words) < size:
        return frozenset([tuple(words)] if words else [])
    return frozenset(zip(*[words[k:] for k in range(size)], strict=False))


def _copies(invented):
    """Texts with copies of many degrees, among them chains and a group without its original."""
    rng = random.Random(5)
    rows = []
    for g in range(8):
        base = invented(rng.choice([6, 40, 90]), 100 + g).split()
        for _ in range(rng.choice([1, 2, 30])):
            own = list(base)
            for _ in range(rng.randint(0, 4)):
                own[rng.randrange(len(own))] = f"w{rng.randrange(6)}"
            rows.append((len(rows) * 3 % 997, " ".join(own)))
    return rows


@pytest.mark.parametrize("few", [0, 8])
def test_components_of_all_links(make_docs, invented, monkeypatch, few):
    monkeypatch.setattr(linking, "FEW", few)
    rows = _copies(invented)
    sets = [_set(t, 4) for _, t in rows]
    links = jaccard_links(sets, 0.8)
    smallest = {}
    for i, (doc_id, _) in enumerate(rows):
        root = links.find(i)
        smallest[root] = min(smallest.get(root, doc_id), doc_id)
    want = {
        (d, len(s), smallest[links.find(i)], d == smallest[links.find(i)])
        for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))
    }
    found = near_duplicates(make_docs(rows), size=4)
    got = found.select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert len(got) == len(rows) and {tuple(r) for r in got} == want


def test_edges(edges):
    found = near_duplicates(edges.withColumn("kept", F.lit("mine")))
    assert found.columns == [*edges.columns, "n_shingles", "component_id", "kept"]
    rows = sorted(map(tuple, found.drop("n_chars").collect()), key=str)
    assert len(rows) == edges.count()
    blank = [r for r in rows if r[1] is None or not r[1].split()]
    assert len(blank) == 4 and all(r[4] == 0 and r[5] == r[0] and r[6] for r in blank)
    same = [r for r in rows if r[1] and r[1] == rows[0][1]]
    assert all(r[5] == 1 for r in rows if r[0] is None and r[1])
    assert {r[6] for r in rows if r[0] is None and r[1]} == {False} and same


def test_empty_table(edges):
    assert near_duplicates(edges.limit(0)).count() == 0


def test_components(spark):
    rng = random.Random(2)
    pairs = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 160)]
    pairs += [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)] + [(7, 7)]
    links = Links(300)
    for a, b in pairs:
        links.join(a, b)
    df = spark.createDataFrame(pairs, "a bigint, b bigint")
    got = {r.node: r.component for r in components(df, Scratch(spark, "test")).collect()}
    assert got == {i: links.find(i) for i in range(300) if links.find(i) != i}


def test_bands_hit_as_often_as_promised():
    rng = np.random.default_rng(1)
    bands, hits, trials = Bands(4, 4), 0, 400
    for _ in range(trials):
        shared = rng.integers(0, 2**64, 80, dtype=np.uint64)
        own = rng.integers(0, 2**64, (2, 10), dtype=np.uint64)
        a, b = (np.unique(np.r_[shared, x]) for x in own)
        hits += bool(np.any(bands.keys(a) == bands.keys(b)))
    assert abs(hits / trials - (1 - bands.miss(0.8))) < 0.08
    assert Bands(24, 4).miss(0.8) < 1e-5


def test_shingles_are_those_of_the_words(invented):
    texts = [invented(50, 1), "a b c", "", " \n", "A  b\tc d e", "é" * 10]
    sizes = [len(_set(t, 4)) for t in texts]
    assert [len(s) for s in shingle_sets([t.encode() for t in texts], 4)] == sizes
    one, other = shingle_sets([b"A b C d", b"a B c D"], 3)
    assert (one == other).all()
