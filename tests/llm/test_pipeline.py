"""The stages one after the other on a small table."""

from __future__ import annotations

import pytest

import corpus_pipeline
from llm.automaton import SuffixAutomaton
from llm.decontaminate import words_of
from llm.quality import quality
from llm.scratch import Scratch

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs]
    scratch = Scratch(spark, "test")
    for _, stage in corpus_pipeline.STAGES:
        out.append(scratch.write(stage(spark, out[-1], FOLDER)))
    return out


def test_stages_keep_columns_and_only_remove(stages):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == [
        "quality_rules",
        "line_dedup",
        "minhash_near_dedup",
        "benchmark_decontamination",
        "sentencepiece_tokens",
    ]
    ids = [{r.doc_id for r in s.select("doc_id").collect()} for s in stages]
    for before, after in zip(ids, ids[1:], strict=False):
        assert after <= before
    for s in stages[:-1]:
        assert s.columns == stages[0].columns
    assert len(ids[-1]) > 0.7 * len(ids[0])


def test_first_stage_follows_the_rules(stages):
    kept = {r.doc_id for r in quality(stages[0]).filter("kept").collect()}
    assert {r.doc_id for r in stages[1].collect()} == kept and len(kept) < stages[0].count()


def test_nothing_of_the_benchmark_is_left(spark, stages):
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()
    machine = SuffixAutomaton(
        [(i, words_of(r.text.encode()), False) for i, r in enumerate(items)], 10
    )
    hit = [
        sum(bool(machine.hits([machine.words.get(w) for w in words_of(r.text.encode())])[0])
            for r in s.collect())
        for s in (stages[3], stages[4])
    ]
    assert hit[0] > 0 and hit[1] == 0


def test_tokens_give_the_text_again(stages):
    assert {r.round_trip for r in stages[-1].collect()} == {True}


def test_run_gives_the_last_stage(spark, stages):
    rows = corpus_pipeline.run(spark, FOLDER).select("doc_id", "ids_crc32").collect()
    want = stages[-1].select("doc_id", "ids_crc32").collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, want))
