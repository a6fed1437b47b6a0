"""Tokens against the reference library, and exact round trips."""

from __future__ import annotations

import random
import zlib

import pytest
import sentencepiece
from pyspark.sql import functions as F

from llm.queries import PIECES
from llm.tokens import decoded, encoded
from llm.transducer import BPE, NORMAL, Transducer


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


@pytest.fixture(scope="module")
def machine():
    with open(PIECES, "rb") as f:
        return Transducer(f.read(), most_known=500)


def _texts(invented):
    rng = random.Random(1)
    texts = [invented(40, k) for k in range(30)]
    texts += ["".join(rng.choices("ab  e.t,▁\néh水ing thZ$$", k=rng.randint(0, 60))) for _ in range(1500)]
    return [*texts, "", " ", "   ", "\n\n", "a" * 70, "$" * 9, " " * 300 + "x", "😀é\x00", " a ", "a  b "]


def test_same_ids_as_the_library(machine, library, invented):
    for text in _texts(invented):
        assert machine.encode(text) == library.encode(text), text


def test_pairs_that_may_follow_each_other(machine):
    rng = random.Random(2)
    pieces = sorted(machine.reached - machine.tied)
    for _ in range(3000):
        a, b = rng.choices(pieces, k=2)
        if rng.random() < 0.6:
            a, b = machine.halves.get(a, (a, b))
        one, other = machine.strings[a], machine.strings[b]
        assert machine._stable(a, b) == (machine.merged(one + other) == [one, other])


def _field(number, value):
    if isinstance(value, bytes):
        return bytes([number << 3 | 2]) + _varint(len(value)) + value
    return bytes([number << 3]) + _varint(value)


def _varint(n):
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def test_unigram_takes_the_lightest_path():
    import struct

    pieces = {"▁": -2.0, "a": -3.0, "b": -3.5, "ab": -4.0, "▁a": -4.5, "▁ab": -7.5, "ba": -5.0}
    model = b"".join(
        _field(1, _field(1, p.encode()) + bytes([2 << 3 | 5]) + struct.pack("<f", s) + _field(3, NORMAL))
        for p, s in pieces.items()
    ) + _field(2, _field(3, 1)) + _field(3, _field(3, 1) + _field(4, 0))
    machine = Transducer(model)
    assert machine.kind != BPE

    def lightest(text):
        best = {0: (0.0, [])}
        for end in range(1, len(text) + 1):
            ways = [
                (best[i][0] - pieces[text[i:end]], best[i][1] + [text[i:end]])
                for i in range(end)
                if i in best and text[i:end] in pieces
            ]
            if ways:
                best[end] = min(ways)
        return best[len(text)][0]

    for text in ("abab", "ab ba", "a b ab", "bbaab", "ba ba"):
        ids = machine.encode(text)
        cost = -sum(pieces[machine.strings[i]] for i in ids)
        assert abs(cost - lightest(machine.normalised(text))) < 1e-6
        assert machine.decode(ids) == text


def test_round_trip_in_tables(make_docs, invented, machine):
    texts = [t for t in _texts(invented) if "\x00" not in t]
    docs = make_docs(list(enumerate(texts)))
    rows = encoded(docs, PIECES).collect()
    for r in rows:
        assert r.token_ids == machine.encode(r.text) and r.n_tokens == len(r.token_ids)
        assert r.round_trip == ("▁" not in r.text)
        packed = b"".join(i.to_bytes(4, "little") for i in r.token_ids)
        assert r.ids_crc32 == zlib.crc32(packed)
    back = decoded(encoded(docs, PIECES).withColumn("text", F.lit("x")), PIECES)
    assert {r.doc_id: r.text for r in back.collect()} == {
        i: t.replace("▁", " ") for i, t in enumerate(texts)
    }


def test_edges(edges):
    found = encoded(edges.withColumn("n_tokens", F.lit("x")), PIECES)
    rows = found.collect()
    assert found.columns.count("n_tokens") == 1 and len(rows) == edges.count()
    for r in rows:
        if r.text is None:
            assert (r.token_ids, r.n_tokens, r.round_trip) == (None, 0, None)
        elif not r.text:
            assert (r.token_ids, r.n_tokens, r.round_trip) == ([], 0, True)
    assert max(r.n_tokens for r in rows) > 30_000
    assert encoded(edges.limit(0), PIECES).count() == 0
    assert decoded(encoded(edges.limit(0), PIECES), PIECES).count() == 0
    assert "token_ids" not in encoded(edges, PIECES, ids=False).columns
