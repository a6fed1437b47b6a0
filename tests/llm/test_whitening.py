"""Whitening against numpy's eigenvectors, and exact sums."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from llm.whitening import OFFSET, SCALE, factored, solved, whitened

SCHEMA = "vec_id bigint, embedding array<double>"


def _vectors(n, d, seed, scale=1.0):
    rng = random.Random(seed)
    base = [[rng.gauss(0, scale * (1 + j)) for j in range(d)] for _ in range(n)]
    return [(i, [a + 0.3 * sum(v[:2]) for a in v]) for i, v in enumerate(base)]


def _by_hand(rows):
    """{vec_id: deviation}, whitened by numpy, shares."""
    x = np.floor(SCALE * np.array([v for _, v in rows])).astype(np.int64) + OFFSET
    n, sums = len(x), [int(c) for c in x.sum(axis=0)]
    deviation = [sum((n * int(a) - s) ** 2 for a, s in zip(row, sums)) for row in x]
    y = x - x.mean(axis=0)
    values, axes = np.linalg.eigh(y.T @ y / n)
    values, axes = values[::-1], axes[:, ::-1]
    return deviation, y @ axes / np.sqrt(np.maximum(values, 1e-300)), values / values.sum()


def _wide(df, k):
    out = {}
    for r in df.collect():
        out.setdefault(r.vec_id, [None] * k)[r.component - 1] = r
    return out


@pytest.mark.parametrize("n, d, k", [(400, 6, 4), (60, 40, 32), (300, 3, 32)])
def test_equals_eigenvectors(spark, n, d, k):
    rows = _vectors(n, d, seed=n)
    found = _wide(whitened(spark.createDataFrame(rows, SCHEMA).repartition(5), k), min(k, d))
    deviation, white, shares = _by_hand(rows)
    assert len(found) == n
    for (i, _), dev, want in zip(rows, deviation, white, strict=True):
        got = found[i]
        assert {r.deviation for r in got} == {dev} and {r.n for r in got} == {n}
        assert all(r.identity_error < 1e-9 for r in got)
        np.testing.assert_allclose([abs(r.whitened) for r in got], np.abs(want[: len(got)]), atol=1e-7)
        np.testing.assert_allclose([r.explained for r in got], shares[: len(got)], rtol=1e-9)
    # One direction of each component for all rows.
    for c in range(min(k, d)):
        signs = {np.sign(found[i][c].whitened * white[i, c]) for i in range(n) if abs(white[i, c]) > 1e-3}
        assert len(signs) == 1


def test_far_from_the_origin(spark):
    """Entries of about 10^9 with a spread of one: centring must be exact."""
    rows = [(i, [1e9 + v / 64 for v in vec]) for i, vec in _vectors(200, 4, seed=3, scale=30)]
    found = _wide(whitened(spark.createDataFrame(rows, SCHEMA), 4), 4)
    deviation, white, _ = _by_hand(rows)
    assert [found[i][0].deviation for i in range(200)] == deviation
    np.testing.assert_allclose(
        [[abs(r.whitened) for r in found[i]] for i in range(200)], np.abs(white), atol=1e-6
    )


def test_badly_conditioned_and_dependent_dimensions(spark):
    rng = random.Random(8)
    rows = []
    for i in range(300):
        a, b, c = (rng.gauss(0, s) for s in (1e4, 10, 0.05))
        rows.append((i, [a, b, c, a, 7.0]))
    df = whitened(spark.createDataFrame(rows, SCHEMA), 5)
    found = _wide(df, 3)
    # A copied and a constant dimension add no component.
    assert {r.component for r in df.collect()} == {1, 2, 3}
    _, white, _ = _by_hand([(i, v[:3]) for i, v in rows])
    got = np.array([[abs(r.whitened) for r in found[i]] for i in range(300)])
    np.testing.assert_allclose(got[:, 1:], np.abs(white[:, 1:]), atol=1e-4)
    assert found[0][0].identity_error < 1e-6


def test_edges(spark):
    nan, inf = math.nan, math.inf
    sound = [[0.1 * i, 0.2 * (i % 3), -0.1 * (i % 5)] for i in range(12)]
    rows = [(i, v, "w", 1) for i, v in enumerate(sound)]
    rows += [(3, sound[3], "w", 1), (None, sound[4], None, None)]
    bad = [None, [None, 1.0, 1.0], [nan, 0.0, 0.0], [inf, 0.0, 0.0], [-inf, 0.0, 0.0], [], [1.0, 2.0]]
    rows += [(100 + i, v, "w", 1) for i, v in enumerate(bad)]
    schema = SCHEMA + ", whitened string, n int"
    found = whitened(spark.createDataFrame(rows, schema), 32).collect()
    assert len(found) == 14 * 3 and {r.n for r in found} == {14}
    assert sorted({r.vec_id for r in found} - {None}) == list(range(12))
    assert sum(r.vec_id is None for r in found) == 3 and sum(r.vec_id == 3 for r in found) == 6


def test_nothing_to_whiten(spark):
    columns = "vec_id component n deviation whitened explained identity_error".split()
    for rows in ([], [(1, None)], [(1, [])], [(1, [0.5, 0.5])], [(i, [0.5, 0.25]) for i in range(9)]):
        found = whitened(spark.createDataFrame(rows, SCHEMA))
        assert found.columns == columns and found.count() == 0


def test_too_large_numbers_are_an_error(spark):
    with pytest.raises(Exception, match="too large"):
        whitened(spark.createDataFrame([(1, [1e300]), (2, [0.0])], SCHEMA)).collect()


def test_triangular_solve_and_shift():
    rng = np.random.default_rng(1)
    upper = np.triu(rng.normal(size=(6, 6))) + 4 * np.eye(6)
    q = rng.normal(size=(9, 6))
    np.testing.assert_allclose(solved(q @ upper, upper), q, atol=1e-12)
    singular = np.outer(np.ones(4), np.ones(4))
    assert np.isfinite(factored(singular, shifted=False)).all()
