"""Lines that differ beyond their words' first characters, against brute force."""

from __future__ import annotations

import random

from llm.lines import line_dedup
from tests.llm.conftest import jaccard_links

K = 5


def _left(lines):
    """Lines that stay, of one line a document."""
    sets = [frozenset(x[i : i + K] for i in range(max(len(x) - K + 1, 1))) for x in lines]
    links = jaccard_links(sets, 0.8)
    return [x for i, x in enumerate(lines) if links.find(i) == i]


def _check(make_docs, lines):
    rows = line_dedup(make_docs(list(enumerate(lines)))).collect()
    got = [r.text for r in sorted(rows, key=lambda r: r.doc_id) if not r.n_removed]
    assert got == _left(lines)
    return got


def test_distinct_lines_with_equal_word_starts_stay(make_docs):
    lines = [
        "https://example.org/news/first-of-all",
        "https://example.com/shop/basket/items",
        "read the full article at https://example.org/a/first",
        "read the full article at https://example.org/b/second",
        "今天天气非常好我们一起去公园散步然后回家吃饭",
        "今天天气非常好我们一起去公园游泳以后再看电影吧",
    ]
    assert _check(make_docs, lines) == lines


def test_lines_without_blanks_and_with_other_ends(make_docs):
    rng = random.Random(4)
    lines = []
    for _ in range(12):
        stem = "".join(rng.choices("abcdefghij0123456789/", k=rng.randint(20, 70)))
        lines.append(stem)
        for _ in range(3):
            at = rng.randrange(len(stem) - 6)
            tail = "".join(rng.choices("uvwxyz", k=rng.randint(1, 9)))
            lines.append(stem[: -len(tail)] + tail if rng.random() < 0.5 else stem[:at] + "zz" + stem[at:])
    got = _check(make_docs, lines)
    assert 12 < len(got) < len(lines)


def test_short_lines_are_removed_unless_asked_to_stay(make_docs):
    texts = ["Share\n\nfirst text of all", "share \n\n今天天气很好", "SHARE\n\n今天天气很好\nok", "ok\n"]
    docs = make_docs(list(enumerate(texts)))
    rows = line_dedup(docs).collect()
    left = [r.text for r in sorted(rows, key=lambda r: r.doc_id)]
    assert left == [texts[0], "\n今天天气很好", "\nok", ""]
    rows = line_dedup(docs, least_chars=16).collect()
    assert [r.text for r in sorted(rows, key=lambda r: r.doc_id)] == texts
