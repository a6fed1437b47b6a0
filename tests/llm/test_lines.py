"""Line dedup against brute force over all pairs of lines."""

from __future__ import annotations

import random
import re
from collections import defaultdict

from pyspark.sql import functions as F

from llm.lines import LEAST_CHARS, PIECE, SHINGLE, line_dedup, without_empty
from tests.llm.conftest import jaccard_links


def _norm(line):
    return re.sub("[\x20\x09-\x0d]+", " ", line.lower()).strip(" ")


def _runs(line):
    return frozenset(line[i : i + SHINGLE] for i in range(max(len(line) - SHINGLE + 1, 1)))


def _brute(rows):
    places = defaultdict(list)
    for n, (doc_id, text, *_) in enumerate(rows):
        for at, line in enumerate((text if text is not None else "").split("\n")):
            if text is not None and len(_norm(line)) >= LEAST_CHARS:
                places[_norm(line)].append((doc_id is None, doc_id or 0, text, at, n))
    lines = list(places)
    links = jaccard_links([_runs(x) for x in lines], 0.8)
    groups = defaultdict(list)
    for i, x in enumerate(lines):
        groups[links.find(i)] += places[x]
    gone = defaultdict(set)
    for found in groups.values():
        # Fully equal rows are one document.
        first = min(found)[:4]
        for *place, n in found:
            if tuple(place) != first:
                gone[n].add(place[3])
    out = []
    for n, (doc_id, text, *_) in enumerate(rows):
        left = text
        if gone[n]:
            left = "\n".join(x for k, x in enumerate(text.split("\n")) if k not in gone[n])
        out.append((doc_id, left, len(gone[n])))
    return sorted(out, key=str)


def _got(found):
    return sorted((tuple(r) for r in found.select("doc_id", "text", "n_removed").collect()), key=str)


def _varied(invented):
    rng = random.Random(8)
    pool = [invented(rng.randint(3, 30), 40 + k) for k in range(12)]
    rows = []
    for d in range(50):
        lines = []
        for _ in range(rng.randint(0, 5)):
            words = rng.choice(pool).split()
            for _ in range(rng.choice([0, 0, 1, 2])):
                words[rng.randrange(len(words))] = "".join(rng.choices("xyz", k=4))
            lines.append(rng.choice([" ", "  "]).join(words).title())
        lines.insert(0, rng.choice(["Short one", "", invented(9, 900 + d)]))
        rows.append((d, "\n".join(lines)))
    return rows


def test_one_line_of_each_component_stays(make_docs, invented):
    rows = _varied(invented)
    assert _got(line_dedup(make_docs(rows))) == _brute(rows)


def test_edges(edges):
    # Documents that share an id are told apart by a hash, whose order is not the texts'.
    docs = edges.filter("doc_id is null or doc_id <> 1 or source is not null")
    rows = [tuple(r) for r in docs.collect()]
    found = line_dedup(docs.withColumns({"n_lines": F.lit("x"), "at": F.lit(1)}))
    assert _got(found) == _brute(rows) and found.columns.count("n_lines") == 1
    assert line_dedup(edges).count() == edges.count()


def test_lines_beyond_one_piece(make_docs, invented):
    """Lines around the length of a piece, with changes at their ends and at the cuts."""
    rng, rows = random.Random(3), []
    for n in (PIECE - 1, PIECE, PIECE + 3, PIECE + 4, PIECE + 5, 2 * PIECE, 2 * PIECE + 4, 2 * PIECE + 9, 2000):
        line = "".join(rng.choices("abcdefgh水ü ", k=n - 1)) + "x"
        changed = [line[:-2] + "yy", line[: PIECE - 2] + "zzz" + line[PIECE + 1 :], line[: n // 2]]
        rows += [(len(rows) + i, x) for i, x in enumerate([line, *changed])]
    assert _got(line_dedup(make_docs(rows))) == _brute(rows)


def test_empty_table_and_emptied_documents(edges, make_docs, invented):
    assert line_dedup(edges.limit(0)).count() == 0
    text = invented(20, 1)
    left = without_empty(line_dedup(make_docs([(1, text), (2, text), (3, None), (4, "")])))
    assert sorted(r.doc_id for r in left.collect()) == [1, 3, 4]


def test_plan_has_no_python(make_docs, invented):
    plan = line_dedup(make_docs(_varied(invented)[:5]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
