from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) or longer tuples; further columns default to one source."""

    def build(rows, schema=SCHEMA):
        full = [(*r, *("en", "s", 1)[len(r) - 2 :]) if len(r) < 5 else r for r in rows]
        return spark.createDataFrame(full, schema)

    return build


@pytest.fixture(scope="session")
def invented():
    """Sentences of invented words, the same in every run."""
    rng = random.Random(11)
    vocabulary = ["".join(rng.choices("abdeiklmnorstu", k=rng.randint(2, 9))) for _ in range(900)]

    def text(n, seed):
        own = random.Random(seed)
        return " ".join(own.choices(vocabulary, k=n)) + "."

    return text


def edge_rows(text):
    """Nulls in every column, empty and blank texts, repeats, a very long text."""
    return [
        (1, text(60, 1), "en", "a", 1),
        (1, text(60, 1), "en", "a", 1),
        (1, text(60, 2), None, None, None),
        (None, text(60, 1), "en", None, 3),
        (None, None, None, None, None),
        (2, None, "en", "a", 0),
        (3, "", "en", "a", 0),
        (4, " \t\n ", "en", "a", 0),
        (5, "One", "en", "a", 0),
        (6, text(30_000, 3), "en", "a", 0),
        (7, "Ünïcödé 水 ▁ \x00 end", "en", "a", 0),
    ]


@pytest.fixture(scope="session")
def edges(make_docs, invented):
    return make_docs(edge_rows(invented))


class Links:
    """Union-find over numbers, for brute force."""

    def __init__(self, n):
        self.up = list(range(n))

    def find(self, i):
        while self.up[i] != i:
            i = self.up[i]
        return i

    def join(self, i, j):
        i, j = sorted((self.find(i), self.find(j)))
        self.up[j] = i


def jaccard_links(sets, least):
    links = Links(len(sets))
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and both >= least * (len(a) + len(sets[j]) - both):
                links.join(i, j)
    return links
