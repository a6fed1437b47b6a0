"""Hard negatives against all pairs by brute force."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from llm import negatives
from llm.negatives import Block, bounded_pairs, hard_negatives, levels, summaries

SCHEMA = "vec_id bigint, embedding array<double>, label int"
ANCHOR = "vec_id % 5 = 0"


def _brute(rows, positives=5, k=3):
    """Rows are (vec_id, vector, label), all sound."""
    xs = [[math.floor(256 * v) for v in vec] for _, vec, _ in rows]
    found = []
    for a, (anchor, _, label) in enumerate(rows):
        if anchor % 5:
            continue
        scored = sorted(
            (-sum(p * q for p, q in zip(xs[a], xs[i])), rows[i][0], i) for i in range(len(rows)) if i != a
        )
        same = [t for t in scored if rows[t[2]][2] == label][:positives]
        for s, pid, _ in same:
            fits = [
                t for t in scored if rows[t[2]][2] != label and 50 * -s <= 100 * -t[0] <= 95 * -s
            ]
            found += [(anchor, pid, n + 1, t[1], -s, -t[0]) for n, t in enumerate(fits[:k])]
    return sorted(found)


def _found(df):
    return sorted(tuple(r) for r in df.collect())


def _clustered(n, d, seed):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(d)] for _ in range(6)]
    rows = []
    for i in range(n):
        centre = rng.choice(centres)
        rows.append((i, [c + rng.gauss(0, 0.4) for c in centre], rng.randrange(4)))
    return rows


@pytest.mark.parametrize("n, d", [(150, 16), (120, 5), (60, 1)])
def test_equals_brute_force(spark, n, d, monkeypatch):
    monkeypatch.setattr(negatives, "ROWS_AT_ONCE", 16)
    monkeypatch.setattr(negatives, "ANCHORS_AT_ONCE", 7)
    rows = _clustered(n, d, seed=d)
    got = _found(hard_negatives(spark.createDataFrame(rows, SCHEMA).repartition(6), ANCHOR))
    assert got == _brute(rows) and got


def test_groups_of_anchors(spark, monkeypatch):
    monkeypatch.setattr(negatives, "ANCHOR_BYTES", 3_000)
    rows = _clustered(90, 4, seed=2)
    assert _found(hard_negatives(spark.createDataFrame(rows, SCHEMA), ANCHOR)) == _brute(rows)


def test_ties_copies_and_a_hot_label(spark):
    rng = random.Random(4)
    same = [0.5, -0.25, 1.0]
    rows = [(i, same, 1) for i in range(60)]
    rows += [(60 + i, [v * 0.75 for v in same], rng.choice([2, 3])) for i in range(40)]
    rows += [(100 + i, [rng.gauss(0, 1) for _ in range(3)], 1) for i in range(30)]
    assert _found(hard_negatives(spark.createDataFrame(rows, SCHEMA).repartition(5), ANCHOR)) == _brute(rows)


def test_edges(spark):
    rows = _clustered(40, 3, seed=9)
    want = _brute(rows)
    bad = [
        (None, rows[0][1], 1),
        (500, None, 1),
        (505, rows[0][1], None),
        (510, [None, 1.0, 1.0], 1),
        (515, [math.nan, 1.0, 1.0], 1),
        (520, [math.inf, 1.0, 1.0], 1),
        (525, [], 1),
        (530, [1.0, 2.0], 1),
    ]
    more = [(*r, i, "x") for i, r in enumerate(rows + bad)]
    df = spark.createDataFrame(more, SCHEMA + ", row int, rank string")
    assert _found(hard_negatives(df, ANCHOR)) == want
    # A repeated row is a row of its own: it can be a positive, and is an anchor.
    again = rows + [rows[0]]
    assert _found(hard_negatives(spark.createDataFrame(again, SCHEMA), ANCHOR)) == _brute(again)


def test_nothing_to_find(spark):
    one_label = [(i, [1.0, i / 9], 1) for i in range(8)]
    no_anchor = [(i, [1.0, i / 9], i % 2) for i in range(1, 4)]
    opposite = [(0, [1.0], 1), (1, [-1.0], 1), (2, [-0.8], 2)]
    for rows in ([], one_label, no_anchor, opposite, [(5, None, 1)]):
        found = hard_negatives(spark.createDataFrame(rows, SCHEMA), ANCHOR)
        assert found.columns == negatives.OUT.replace(" bigint", "").replace(" int", "").split(", ")
        assert found.count() == 0


def _block(x):
    n = len(x)
    parts = [summaries(x, k) for k in levels(x.shape[1])]
    means, deviations = (np.hstack(side) for side in zip(*parts))
    return Block(np.arange(n), np.arange(n), np.zeros(n), x, means, deviations)


def test_bounds_hold_and_leave_pairs_out(monkeypatch):
    rng = np.random.default_rng(5)
    # Vectors that are even over their segments are told apart by the summaries alone.
    steps = np.repeat(rng.integers(-300, 300, size=(80, 8)), 4, axis=1)
    x = steps + rng.integers(-3, 4, size=steps.shape)
    a, b = _block(x[:20]), _block(x[20:])
    exact = x[:20] @ x[20:].T
    start = 0
    for k in levels(32):
        part = slice(start, start + k)
        start += k
        middle = a.means[:, part] @ b.means[:, part].T
        room = a.deviations[:, part] @ b.deviations[:, part].T
        assert (exact <= middle + room + 0.5).all() and (exact >= middle - room - 0.5).all()
    sizes = []
    real = negatives.products
    monkeypatch.setattr(negatives, "products", lambda p, q, m: sizes.append(len(p) * len(q)) or real(p, q, m))
    low = np.partition(exact, -3, axis=1)[:, -3]
    i, j, score = bounded_pairs(a, b, np.ones(exact.shape, bool), low, None)
    assert sorted(zip(i, j)) == sorted(zip(*np.nonzero(exact >= low[:, None])))
    assert (score == exact[i, j]).all() and sum(sizes) < exact.size


def test_large_numbers():
    big = np.array([[1 << 26, 3], [1 << 26, -1]])
    assert negatives.products(big, big, float(1 << 54)).tolist() == (big @ big.T).tolist()
    with pytest.raises(OverflowError):
        negatives.products(big, big, float(1 << 60))
