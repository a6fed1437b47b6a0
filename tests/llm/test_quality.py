"""Base measures and common lines against plain Python."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from llm.quality import quality


def _words(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def _norm(line):
    return re.sub("[\x20\x09-\x0d]+", " ", re.sub("[A-Z]", lambda m: m[0].lower(), line)).strip(" ")


def _base(text):
    words = _words(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    hit = {i + k for i, x in enumerate(windows) if often[x] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if _words(x)]
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text or ""),
        len(lines) - len(set(lines)),
        len(hit),
    )


def _brute(rows, share=0.05, at_least=10):
    holders, texts = defaultdict(set), defaultdict(set)
    for _, text, _, source, _ in rows:
        texts[source].add(text)
        for line in (text or "").split("\n"):
            if _words(line):
                holders[source, _norm(line)].add(text)
    out = []
    for doc_id, text, _, source, _ in rows:
        n = {s: len(holders[source, _norm(s)]) for s in (text or "").split("\n") if _words(s)}
        common = {s for s, k in n.items() if k > at_least and k > share * len(texts[source])}
        gone = [x for x in (text or "").split("\n") if x in common]
        base = _base(text)
        left = base[0] - sum(len(_words(x)) for x in gone)
        failed = base[0] < 10 or 100 * base[4] > 20 * base[0]
        depleted = bool(gone) and (left < 10 or left < 0.3 * base[0])
        kept_text = text
        if gone:
            kept_text = "\n".join(x for x in text.split("\n") if x not in common)
        out.append((doc_id, kept_text, *base, len(gone), left, failed, not failed and not depleted))
    return sorted(out, key=str)


def _got(found):
    names = ["doc_id", "text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    names += ["n_common_lines", "n_words_left", "base_failed", "kept"]
    return sorted((tuple(r) for r in found.select(*names).collect()), key=str)


def test_measures_and_common_lines(make_docs, invented):
    rng = random.Random(3)
    header, footer = "All  Rights\treserved here", invented(40, 1)
    rows = []
    for d in range(60):
        lines = [invented(rng.randint(1, 30), 300 + d * 7 + k) for k in range(rng.randint(0, 6))]
        if d % 2:
            lines += rng.choices([header, header.upper(), footer], k=rng.randint(1, 3))
        if d % 9 == 0:
            lines += lines[:2] * 2 + ["# * | <>", ""]
        rows.append((d, "\n".join(lines), "en", rng.choice(["a", "a", None]), 1))
    rows += [(5, rows[5][1], "en", "a", 1)] * 30
    assert _got(quality(make_docs(rows))) == _brute(rows)


def test_edges(edges):
    rows = [tuple(r) for r in edges.collect()]
    clash = edges.withColumns({"kept": F.lit(7), "host": F.lit(1), "line": F.lit("x")})
    found = quality(clash)
    assert _got(found) == _brute(rows) and {"host", "line"} <= set(found.columns)
    assert found.columns.count("kept") == 1


def test_empty_table(edges):
    assert quality(edges.limit(0)).count() == 0
