"""Operators for training-data corpora: deduplication, filtering, archives and tokens.

Nothing outside this package imports it.  Its queries are in `llm.queries`, their SQL
in `llm.oracle`; `corpus_pipeline.py` at the top of the repository chains five of the
operators.
"""
