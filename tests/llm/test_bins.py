"""Minima of bins are those of permutations over all shingles, for lines of any length."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from llm.lines import BANDS, BIN_BITS, BINS, FILLED, MARK_BITS, MARKS, PIECE, ROWS, SHINGLE, line_dedup
from llm.lines import _binned, _hashes, _lines
from tests.llm.test_lines import _brute, _got


def _texts():
    rng = random.Random(9)
    lengths = (1, SHINGLE, 9, 40, 90, PIECE, PIECE + 1, 400, 3000)
    texts = ["".join(rng.choices("abcdeé水fgh ", k=n - 1)) + "z" for n in lengths]
    return [*texts, "ab" * 300, "abcdefgh" * 60]


def test_minima_are_those_of_all_shingles(make_docs):
    docs = make_docs(list(enumerate(_texts())))
    distinct = _lines(docs, 1).groupBy("k1", "k2").agg(F.first("line").alias("line"))
    hashes = {}
    for r in _hashes(distinct).collect():
        hashes.setdefault(r.k1, []).append(r.x & 0xFFFFFFFF)
    found = _binned(distinct).collect()
    assert len(found) == len(_texts())
    low = 32 - BIN_BITS
    for r in found:
        of = hashes[r.node]
        minima = [min(x ^ (k << low) for x in of) for k in range(BANDS * ROWS)]
        lanes = 64 // MARK_BITS
        for j, name in enumerate(MARKS):
            mark = sum((m & 255) << 8 * k for k, m in enumerate(minima[j * lanes : (j + 1) * lanes]))
            assert r[name] & 0xFFFFFFFFFFFFFFFF == mark
        assert r.filled == len({x >> low for x in of}) and len(r.bands) == BANDS


@pytest.mark.parametrize("bins, filled", [(BINS, FILLED), (33, 32)])
def test_repetitive_and_short_lines_are_linked(make_docs, monkeypatch, bins, filled):
    """A long line of few shingles meets a short one of the same; so do lines around PIECE."""
    monkeypatch.setattr("llm.lines.BINS", bins)
    monkeypatch.setattr("llm.lines.FILLED", filled)
    rng = random.Random(2)
    lines = ["ab" * 300, "ab" * 20, "=" * 700, "=" * 30, "abcdefgh" * 60, "abcdefgh" * 9]
    for n in (PIECE - 3, PIECE - 1, PIECE, PIECE + 1, 170):
        line = "".join(rng.choices("abcdefghij ", k=n - 1)) + "x"
        lines += [line, line + "yy", line[3:]]
    rows = list(enumerate(lines))
    assert _got(line_dedup(make_docs(rows))) == _brute(rows)
