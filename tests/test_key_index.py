"""Merges that look only where the key index says that a key may be."""

from __future__ import annotations

import datetime as dt
import glob
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.operators import key_index
from tripmart.operators.key_index import blocks_for
from tripmart.schemas import Table
from tripmart.store import TableStore

ROWS = Table(
    "t/rows",
    T.StructType(
        [
            T.StructField("k", T.StringType()),
            T.StructField("num", T.LongType()),
            T.StructField("v", T.IntegerType()),
            T.StructField("month", T.DateType()),
        ]
    ),
    keys=("k", "num"),
    partition_by="month",
    indexed=True,
)
MONTHS = [dt.date(2024, m, 1) for m in range(1, 7)]


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "store"))


@pytest.fixture
def rows(spark):
    return lambda *r: spark.createDataFrame(list(r), ROWS.schema)


def _content(store):
    return sorted((tuple(r) for r in store.read(ROWS).select("k", "num", "v", "month").collect()), key=str)


def _filled(store, rows, each=40):
    full = [(f"{m.month}-{i}", i, 0, m) for m in MONTHS for i in range(each)]
    store.upsert(ROWS, rows(*full))
    return {(k, n): (k, n, v, m) for k, n, v, m in full}


def _spoil(store, month):
    """Files of a month that cannot be read any more, under their old names."""
    for file in glob.glob(f"{store.path(ROWS)}/month={month}/part-*"):
        Path(file).write_bytes(b"not a table")
        Path(file).with_name(f".{Path(file).name}.crc").unlink(missing_ok=True)


def test_only_months_that_may_hold_a_key_are_read(store, rows):
    model = _filled(store, rows)
    untouched = [m for m in MONTHS if m.month in (3, 4, 6)]
    kept = {m: [Path(f) for f in glob.glob(f"{store.path(ROWS)}/month={m}/part-*")] for m in untouched}
    whole = {f: f.read_bytes() for files in kept.values() for f in files}
    for month in untouched:
        _spoil(store, month)
    # Two trips move from the first and second month into the fifth; one is new.
    moved = [("1-3", 3, 1, MONTHS[4]), ("2-7", 7, 1, MONTHS[4]), ("new", 1, 1, MONTHS[4])]
    result = store.upsert(ROWS, rows(*moved))
    assert result.partitions == (MONTHS[0], MONTHS[1], MONTHS[4])
    for file, content in whole.items():
        file.write_bytes(content)
    model |= {(r[0], r[1]): r for r in moved}
    assert _content(store) == sorted(model.values(), key=str)


def test_false_positives_cost_nothing_but_a_look(store, rows, monkeypatch):
    monkeypatch.setattr(key_index, "BITS_PER_KEY", 0.01)
    monkeypatch.setattr(key_index, "_masks", lambda keys: [F.lit(1).cast("bigint")] * 8)
    model = _filled(store, rows)
    index = store.key_index(ROWS)
    # A key between the least and greatest of every month that no month holds.
    probe = rows(("2-05", 5, 0, MONTHS[0]))
    assert index.partitions_that_may_hold(probe, MONTHS) == [MONTHS[1]]
    moved = [("1-3", 3, 1, MONTHS[4]), ("1-30x", 7, 1, MONTHS[4])]
    store.upsert(ROWS, rows(*moved))
    model |= {(r[0], r[1]): r for r in moved}
    assert _content(store) == sorted(model.values(), key=str)


def test_no_key_is_ever_missed(store, rows):
    rng = random.Random(3)
    full = [(f"{rng.getrandbits(60):x}", rng.randrange(9), 0, rng.choice(MONTHS)) for _ in range(3_000)]
    store.overwrite(ROWS, rows(*full))
    index = store.key_index(ROWS)
    assert index.refresh() == MONTHS
    for month in MONTHS:
        some = [r for r in full if r[3] == month]
        for r in rng.sample(some, 5):
            assert month in index.partitions_that_may_hold(rows(r), MONTHS)
    strange = rows(*[(f"{rng.getrandbits(60):x}", 1, 0, MONTHS[0]) for _ in range(500)])
    assert index.partitions_that_may_hold(strange, MONTHS) == []


def test_the_index_follows_its_table(store, rows):
    model = _filled(store, rows)
    index = store.key_index(ROWS)
    assert index.stale() == []
    # Replaced behind the index: it is brought up to date before it is asked.
    store.replace_partitions(ROWS, rows(("late", 1, 5, MONTHS[2])), [MONTHS[2]])
    assert index.stale() == [MONTHS[2]]
    store.upsert(ROWS, rows(("late", 1, 6, MONTHS[0])))
    model = {k: r for k, r in model.items() if r[3] != MONTHS[2]} | {("late", 1): ("late", 1, 6, MONTHS[0])}
    assert _content(store) == sorted(model.values(), key=str)
    assert store.partitions(ROWS) == [m for m in MONTHS if m != MONTHS[2]]
    index.refresh()
    assert store.partitions(index.table) == store.partitions(ROWS)


def test_null_keys_never_match(store, rows):
    store.upsert(ROWS, rows(("a", 1, 1, MONTHS[0]), (None, 1, 2, MONTHS[0]), ("b", None, 3, MONTHS[1])))
    store.upsert(ROWS, rows((None, 1, 4, MONTHS[2]), ("b", None, 5, MONTHS[2]), ("a", 1, 6, MONTHS[2])))
    assert sorted(r[2] for r in _content(store)) == [2, 3, 4, 5, 6]


def test_other_keys_and_plain_tables_read_all_months(store, rows, spark):
    _filled(store, rows, each=3)
    source = rows(("zzz", 2, 9, MONTHS[0]))
    found = store.partitions_holding(ROWS, source, ["num"], [MONTHS[0]])
    assert sorted(found) == MONTHS[1:]


def test_sizes_of_filters():
    sizes = [blocks_for(n) for n in (0, 1, 100, 1_000, 10**6, 10**9)]
    assert sizes[0] == sizes[1] == 1
    for n in (1_000, 123_456, 10**9):
        assert 1.0 <= blocks_for(n) / (n * 48 / 512) <= 1.25
    # Few sizes for many months.
    assert len({blocks_for(n) for n in range(2_500_000, 3_500_000, 1_000)}) <= 4
