"""Least moved bytes, near-equal shards, gapless slots."""

from __future__ import annotations

import itertools
import random
import zlib

import pytest
from pyspark.sql import functions as F

from llm import shards
from llm.flow import transfers
from llm.scratch import Scratch


def _cheapest(held, wanted, cost):
    """The least cost over all ways to send single units."""
    units = [i for i, n in enumerate(held) for _ in range(n)]
    rooms = [j for j, n in enumerate(wanted) for _ in range(n)]
    return min(
        sum(cost(i, j) for i, j in zip(units, order, strict=True))
        for order in set(itertools.permutations(rooms))
    )


def test_flows_cost_the_least():
    rng = random.Random(1)
    for trial in range(60):
        n, m, total = rng.randint(1, 3), rng.randint(1, 3), rng.randint(0, 6)
        held, wanted = [0] * n, [0] * m
        for _ in range(total):
            held[rng.randrange(n)] += 1
            wanted[rng.randrange(m)] += 1
        prices = [[rng.randrange(5) for _ in range(m)] for _ in range(n)]

        def cost(i, j, prices=prices, plain=trial % 2):
            return int(i != j) if plain else prices[i][j]

        flow = transfers(held, wanted, cost)
        assert [sum(v for (a, _), v in flow.items() if a == i) for i in range(n)] == held
        assert [sum(v for (_, b), v in flow.items() if b == j) for j in range(m)] == wanted
        assert sum(cost(i, j) * v for (i, j), v in flow.items()) == _cheapest(held, wanted, cost)


@pytest.fixture
def resharded(spark, make_docs, invented, monkeypatch):
    monkeypatch.setattr(shards, "BLOCK_ROWS", 40)
    rng = random.Random(2)
    rows = [(k, invented(rng.randint(1, 60), k)) for k in range(900)] + [(5, "same")] * 300
    scratch = Scratch(spark, "test")
    old = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4))
    docs = make_docs(rows).withColumn("shard", F.lit("mine"))
    return shards.reshard(shards.placed(docs.repartition(3), old, scratch), 4, 6, scratch)


def test_shards(resharded):
    rows = resharded.collect()
    sizes = [0] * 6
    for r in rows:
        assert r.size == len(r.text.encode()) + 16
        assert r.old_shard == zlib.crc32(str(r.doc_id).encode()) % 4
        sizes[r.shard] += r.size
    assert len(rows) == 1200 and max(sizes) - min(sizes) < 300
    for k in range(6):
        assert sorted(r.slot for r in rows if r.shard == k) == list(range(sum(r.shard == k for r in rows)))
    held = [sum(r.size for r in rows if r.old_shard == k) for k in range(4)]
    least = sum(max(0, n - sum(held) / 6) for n in held)
    moved = sum(r.size for r in rows if r.old_shard != r.shard)
    assert abs(moved - least) < 1500
    assert sum(r.bytes for r in shards.moves(resharded).collect()) == moved


def test_affected_shards_are_written(spark, resharded, tmp_path):
    touched = shards.write_affected(resharded, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r.shard for r in back.select("shard").distinct().collect()) == touched
    assert back.count() == resharded.filter(F.col("shard").isin(touched)).count()


def test_edges(spark, edges):
    scratch = Scratch(spark, "test")
    for docs in (edges, edges.limit(0)):
        rows = shards.reshard(shards.placed(docs, F.lit(0), scratch), 1, 3, scratch).collect()
        assert len(rows) == docs.count()
        for k in range(3):
            slots = sorted(r.slot for r in rows if r.shard == k)
            assert slots == list(range(len(slots)))
