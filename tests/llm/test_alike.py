"""Lines that only meet in a bucket are told apart by their marks, not by their text."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from llm import linking
from llm.lines import line_dedup
from llm.scratch import Scratch
from tests.llm.conftest import jaccard_links
from tests.llm.test_lines import _brute, _got


def _sets():
    """Five groups of sets that grow apart step by step, and sets of their own."""
    rng = random.Random(4)
    out = []
    for g in range(5):
        at = [1000 * g + k for k in range(40)]
        for _ in range(12):
            out.append(frozenset(at))
            at = at[rng.randint(1, 6) :] + [10_000 + rng.randrange(10**6) for _ in range(3)]
    return out + [frozenset(range(10**8 + 50 * k, 10**8 + 50 * k + 20)) for k in range(60)]


@pytest.mark.parametrize("mates, pairs", [(8192, 16), (8192, 0), (3, 16)])
def test_components_are_those_of_all_pairs(spark, monkeypatch, mates, pairs):
    monkeypatch.setattr(linking, "MATES", mates)
    monkeypatch.setattr(linking, "PAIRS", pairs)
    sets = _sets()
    kind = "node bigint, of array<bigint>"
    texts = spark.createDataFrame([(i, sorted(s)) for i, s in enumerate(sets)], kind)
    compared = []

    def joined(found):
        compared.append(found.count())
        left = texts.select(F.col("node").alias("a"), F.col("of").alias("x"))
        right = texts.select(F.col("node").alias("b"), F.col("of").alias("y"))
        return found.join(left, "a").join(right, "b")

    def verify(found):
        same = F.size(F.array_intersect("x", "y"))
        both = F.size(F.array_union("x", "y"))
        return joined(found).select("a", "b", (same / both).alias("similarity"))

    def differ(found):
        return joined(found).select(
            "a",
            "b",
            F.size("x").cast("bigint").alias("size_a"),
            F.array_except("x", "y").alias("lost"),
            F.array_except("y", "x").alias("gained"),
        )

    scratch = Scratch(spark, "alike")
    # Two buckets hold all nodes; the mark of a set is its group, of which a link has one.
    mark = F.floor(F.array_min("of") / 1000)
    bands = texts.select(F.explode(F.array(F.lit(1), F.lit(2))).alias("bucket"), "node", mark.alias("mark"))
    members = scratch.write(linking.bucket_members(bands))

    def alike(x, y):
        return F.col(f"{x}.mark") == F.col(f"{y}.mark")

    close = scratch.write(linking.with_mates(members, alike))
    found = linking.linked_alike(close, alike, verify, differ, 0.8, scratch)
    got = {r["node"]: r["component"] for r in found.collect()}
    links = jaccard_links(sets, 0.8)
    assert {i: got.get(i, i) for i in range(len(sets))} == {
        i: links.find(i) for i in range(len(sets))
    }
    if pairs and mates > 3:
        # All nodes with one hub alone would be 119 pairs; few of those are alike.
        groups = 5 * 12 * 11 // 2
        assert sum(compared) <= groups + 60 * 59 // 2 and compared[0] < 119


def test_variants_of_one_line_are_not_paired_with_each_other(make_docs, monkeypatch):
    rng = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyz"
    base = "".join(rng.choices(letters, k=300))
    rows = []
    for d in range(120):
        line = list(base)
        for k in range(4):
            at = 75 * k + rng.randrange(60)
            line[at : at + 3] = rng.choices(letters, k=3)
        rows.append((d, "".join(line)))
    written = []
    write = Scratch.write

    def counting(self, df):
        out = write(self, df)
        if out.columns == ["a", "b", "similarity"]:
            written.append(out.count())
        return out

    monkeypatch.setattr(Scratch, "write", counting)
    assert _got(line_dedup(make_docs(rows))) == _brute(rows)
    assert sum(written) < 120 * 119 // 4


def test_lines_that_share_a_run_only_are_not_compared(make_docs, monkeypatch):
    rng = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = [
        (d, "the same words first, " + "".join(rng.choices(letters, k=160))) for d in range(300)
    ]
    rows += [(300 + d, rows[7 * d][1] + "!") for d in range(20)]
    written = []
    write = Scratch.write

    def counting(self, df):
        out = write(self, df)
        if out.columns == ["a", "b", "similarity"]:
            written.append(out.count())
        return out

    monkeypatch.setattr(Scratch, "write", counting)
    assert _got(line_dedup(make_docs(rows))) == _brute(rows)
    assert 20 <= sum(written) < 60
