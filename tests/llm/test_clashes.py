"""Columns of the documents that are named like the operators' own."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from llm.kneser_ney import quality_classified
from llm.lines import line_dedup
from llm.near_dedup import near_duplicates
from llm.passages import without_repeats
from llm.quality import quality

INTERNAL = (
    "_host _key _lines _common _removed _late _version _text _k1 _k2 _spans _windows _row others carried"
    " row host line late version node k1 k2 key component place"
).split()


def _classified(docs):
    labels = docs.sparkSession.createDataFrame([(1, 1, 0)], "doc_id bigint, quality int, toxic int")
    return quality_classified(docs, labels)


@pytest.mark.parametrize(
    "operator",
    [quality, line_dedup, near_duplicates, _classified, lambda d: without_repeats(d, exact_words=25)],
    ids=["quality", "line_dedup", "near_duplicates", "quality_classified", "without_repeats"],
)
def test_internal_names(make_docs, invented, operator):
    """Every row keeps its values, and the result is that without the columns."""
    shared = invented(40, 1)
    docs = make_docs([(k, f"{shared}\n{invented(60, 10 + k)}") for k in range(4)] + [(9, shared), (10, None)])
    plain = operator(docs)
    clashing = docs.select(*[F.lit(f"mine {n}").alias(n) for n in INTERNAL], "*", F.lit(1).alias("_a b"))
    found = operator(clashing)
    added = [c for c in plain.columns if c not in docs.columns]
    assert found.columns == [*clashing.columns, *added]
    rows = found.collect()
    assert all(r[n] == f"mine {n}" for r in rows for n in INTERNAL) and all(r["_a b"] == 1 for r in rows)
    same = sorted(map(str, plain.collect()))
    assert sorted(str(r) for r in found.select(*plain.columns).collect()) == same
