"""Archives are read back whole; runs are merged in one order."""

from __future__ import annotations

import gzip
import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from llm import warc
from llm.merge import merged
from llm.scratch import Scratch

NOW = "2024-01-01T00:00:00Z"
SCHEMA = "page_id bigint, url string, html string"


def _pages():
    rng = random.Random(3)
    bodies = ["é" * 60, "x" * 99, "y" * 100, "a\r\n\r\nWARC/1.1\r\nb" * 9, "", None]
    rows = []
    for k in range(120):
        html = rng.choice(bodies) if k % 2 else f"<p>{k}</p>" * rng.randint(1, 40)
        host = rng.choice(["http://a.org", "https://www.A.org", "http://b.a.org:80"])
        rows.append((k, f"{host}/{rng.randrange(5)}/?b=1&a={rng.randrange(3)}", html))
    rng.shuffle(rows)
    return [*rows, rows[0], (None, None, "y" * 100), (None, "http://[bad", "z"), (500, "a\r\nb", "z" * 5000)]


def _want(rows):
    smallest = defaultdict(list)
    for page_id, _, html in rows:
        if page_id is not None:
            smallest[html or ""].append(page_id)
    out = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        first = min(smallest[html or ""], default=None) if len(data) >= 100 else None
        again = first is not None and page_id != first
        digest = hashlib.sha256(data).hexdigest()
        kind = "revisit" if again else "response"
        out.append((page_id, len(data), digest, kind, first if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("few", [0, 200_000])
def test_pages_come_back(spark, monkeypatch, few):
    monkeypatch.setattr(warc, "RECORDS_PER_FILE", 7)
    monkeypatch.setattr(warc, "BROADCAST_ROWS", few)
    rows = _pages()
    pages = spark.createDataFrame(rows, SCHEMA).withColumn("digest", F.lit("mine"))
    index = warc.archived(pages.repartition(3), F.lit(NOW))
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, index.select(names).collect()), key=str) == _want(rows)


def test_files_follow_the_format_and_offsets_hold(spark, tmp_path):
    pages = spark.createDataFrame(_pages(), SCHEMA)
    folder = str(tmp_path / "archives")
    index = warc.archived(pages, F.lit(NOW), folder).collect()
    plain = {}
    for r in index:
        path = r.file.removeprefix("file:")
        path = "/" + path.lstrip("/")
        if path not in plain:
            with gzip.open(path) as f:
                plain[path] = f.read()
        record = plain[path][r.offset : r.offset + r.length]
        assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
        head, _, rest = record.partition(b"\r\n\r\n")
        size = int(head.split(b"Content-Length: ")[1].split(b"\r\n")[0])
        assert len(rest) == size + 4
    assert sum(r.length for r in index) == sum(map(len, plain.values()))


def test_histories_are_in_one_order(spark):
    pages = spark.createDataFrame(_pages(), SCHEMA)
    scratch = Scratch(spark, "test")
    folder = scratch.new_path()
    seconds = F.concat(F.lit("2024-01-01T00:00:"), F.lpad(F.col("page_id") % 60, 2, "0"), F.lit("Z"))
    warc.write_archives(pages.repartition(4), folder, F.coalesce(seconds, F.lit(NOW)), scratch)
    runs = scratch.write(warc.runs(spark, folder))
    rows = warc.merged_index(runs, rows_per_merge=20).orderBy("part", "row").collect()
    keys = [(r.url_key, r.captured, r.page_id is None, r.page_id or 0) for r in rows]
    assert len(rows) == pages.count() and keys == sorted(keys)
    assert len({r.part for r in rows}) > 2


def test_spellings_of_one_address():
    same = ["http://www.A.org/x/", "https://a.org//x", "http://a.org:80/X"]
    assert {warc.url_key(u) for u in same} == {"org,a)/x"}
    assert warc.url_key("http://a.org?b=2&a=1") == "org,a)/?a=1&b=2"


def test_damage_is_an_error(spark, tmp_path):
    scratch = Scratch(spark, "test")
    folder = tmp_path / "archives"
    pages = spark.createDataFrame([(1, "http://a", "some text")], SCHEMA)
    warc.write_archives(pages.coalesce(1), str(folder), F.lit(NOW), scratch)
    file = next(f for f in folder.iterdir() if f.name.endswith(".gz") and f.stat().st_size > 30)
    good = gzip.decompress(file.read_bytes())
    for bad in (good.replace(b"some", b"same"), good[:-9], good + b"x"):
        with pytest.raises(ValueError):
            data = memoryview(gzip.compress(bad))
            [warc._entry("f", r) for r in warc.read_records(data)]
    # Members of one file are read on, as other writers make them.
    twice = memoryview(gzip.compress(good) * 2)
    assert len(list(warc.read_records(twice))) == 2


def test_merging():
    rng = random.Random(1)
    for _ in range(300):
        runs = [sorted((rng.randrange(9), i) for _ in range(rng.randrange(6))) for i in range(rng.randrange(7))]
        assert list(merged(runs)) == sorted(x for r in runs for x in r)


def test_empty_table(spark):
    assert warc.archived(spark.createDataFrame([], SCHEMA), F.lit(NOW)).count() == 0
