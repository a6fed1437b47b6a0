"""Resharding rewrites the stored files of affected shards, and results come from files."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import functions as F

import llm.queries as queries
from llm import shards
from llm.scratch import Scratch


def _moved(spark, docs, tmp_path, old, new, shard):
    scratch = Scratch(spark, "test")
    before, after = tmp_path / "before", tmp_path / "after"
    stored = shards.write_shards(docs, shard, str(before))
    rows = shards.reshard(scratch.write(shards.sized(stored)), old, new, scratch)
    return shards.rewritten(stored, rows, str(after), scratch), rows, after


def test_affected_shards_are_rewritten_and_others_keep_their_files(spark, make_docs, tmp_path):
    # Three shards of 40, 20 and 30 rows of one size: shard 2 is right already.
    texts = [(k, "x" * 84) for k in range(90)]
    shard = F.when(F.col("doc_id") < 40, 0).when(F.col("doc_id") < 60, 1).otherwise(2)
    out, rows, after = _moved(spark, make_docs(texts), tmp_path, 3, 3, shard)
    assert sorted(p.name for p in after.glob("shard=*")) == ["shard=0", "shard=1"]
    got = {r.doc_id: r for r in out.collect()}
    want = {r.doc_id: r for r in rows.collect()}
    assert len(got) == 90
    for d, r in got.items():
        assert (r.text, r.size) == ("x" * 84, 100)
        assert (r.shard, r.slot, r.old_shard) == (want[d].shard, want[d].slot, want[d].old_shard)


def test_edges(spark, edges, tmp_path):
    out, _, _ = _moved(spark, edges, tmp_path, 1, 3, F.lit(0))
    key = ["doc_id", "text"]
    assert sorted(map(str, out.select(*key).collect())) == sorted(map(str, edges.select(*key).collect()))
    for k in range(3):
        slots = sorted(r.slot for r in out.collect() if r.shard == k)
        assert slots == list(range(len(slots)))


def test_query_reads_its_columns_from_shard_files(spark):
    found = queries.op7_min_cost_flow_sharding(spark, "/root/testdata/sf0.001")
    files = found.select("doc_id").inputFiles()
    assert files and not any(Path(f).parent.name == "documents.parquet" for f in files)
    assert any("shard=" in f for f in files)


def test_slots_follow_the_rows_and_texts_are_not_shuffled(
    spark, make_docs, invented, tmp_path, monkeypatch
):
    monkeypatch.setattr(shards, "BLOCK_ROWS", 50)
    # Both the groups and the rows of divided groups are small here, the texts are not hinted.
    rows = [(k, invented(1 + k * 7 % 90, k)) for k in range(600)] + [(5, "same")] * 200
    rows += [(None, None)] * 3
    old = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(4))
    docs = make_docs(rows).repartition(3)
    scratch = Scratch(spark, "test")
    stored = shards.write_shards(docs, old, str(tmp_path / "before"))
    moved = scratch.write(shards.reshard(scratch.write(shards.sized(stored)), 4, 6, scratch))
    found = shards.located(stored, moved, scratch)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan
    want = {r["_row"]: (r.shard, r.slot, r.old_shard) for r in moved.collect()}
    got = {r["_row"]: (r.shard, r.slot, r.old_shard) for r in found.collect()}
    assert len(want) == 803 and got == want
    # Rows of one task, shard and class have consecutive numbers.
    groups = moved.groupBy("old_shard", "_class", F.shiftright("_row", 33).alias("task")).agg(
        (F.max("_row") - F.min("_row") + 1).alias("span"), F.count(F.lit(1)).alias("n")
    )
    assert groups.filter("span <> n").count() == 0
