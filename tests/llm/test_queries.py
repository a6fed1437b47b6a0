"""Registered queries: whole tables, agreed columns, and the same rows as their SQL."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_points
from llm.oracle import STATEMENTS
from llm.queries import REGISTERED
from tests.compare import connect, differences

FOLDER = "/root/testdata/sf0.001"
COLUMNS = {
    "op1": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op3": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op4": "doc_id n_shingles component_id kept",
    "op5": "doc_id held_out lang_pred score",
    "op7": "doc_id size text_crc32 law shard slot grown_shard",
    "op8": "page_id payload_bytes payload_digest record_type refers_to",
    "op11": "vec_id component n deviation whitened explained identity_error",
    "op12": "doc_id start n_tokens ids_crc32",
    "op13": "anchor_id positive_id rank negative_id positive_score negative_score",
}


def test_all_are_registered():
    names = {name.split("_")[0] for name in REGISTERED}
    assert names == {f"op{n}" for n in range(1, 14)} and len(REGISTERED) == 13
    assert set(REGISTERED) | {"pipeline"} <= set(entry_points.queries())
    assert set(STATEMENTS) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(REGISTERED))
def test_rows(spark, name):
    con = connect(FOLDER)
    df = REGISTERED[name](spark, FOLDER)
    assert set(COLUMNS.get(name.split("_")[0], "").split()) <= set(df.columns)
    if name in STATEMENTS:
        assert differences(df, con, STATEMENTS[name]) == []
    else:
        source = "embeddings" if "whitening" in name else "documents"
        each = 32 if "whitening" in name else 1
        assert df.count() == each * con.execute(f"SELECT count(*) FROM {source}").fetchall()[0][0]
