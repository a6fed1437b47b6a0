"""The token query returns the ids that its digest is of."""

from __future__ import annotations

import struct
import zlib

from llm.queries import op9_sentencepiece_tokens


def test_query_returns_the_ids(spark):
    rows = op9_sentencepiece_tokens(spark, "/root/testdata/sf0.001").collect()
    assert any(r.token_ids for r in rows)
    for r in rows:
        if r.token_ids is not None:
            assert len(r.token_ids) == r.n_tokens
            assert zlib.crc32(struct.pack(f"<{r.n_tokens}i", *r.token_ids)) == r.ids_crc32
