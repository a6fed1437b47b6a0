"""Loads that are killed while they publish: all of them or nothing is found afterwards."""

from __future__ import annotations

import datetime as dt
import glob
import os
from pathlib import Path

import pytest
from pyspark.sql import types as T

from tripmart.operators import packing, publishing
from tripmart.schemas import Table
from tripmart.store import TableStore

FACTS = Table(
    "t/facts",
    T.StructType(
        [
            T.StructField("k", T.StringType()),
            T.StructField("v", T.IntegerType()),
            T.StructField("day", T.DateType()),
        ]
    ),
    keys=("k",),
    partition_by="day",
)
PLAIN = Table("t/plain", FACTS.schema, keys=("k",))
D1, D2, D3 = dt.date(2024, 1, 1), dt.date(2024, 2, 1), dt.date(2024, 3, 1)


class Killed(BaseException):
    """Not an error that anything could handle."""


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "store"))


@pytest.fixture
def facts(spark):
    return lambda *rows: spark.createDataFrame(list(rows), FACTS.schema)


def _killed_at(monkeypatch, step, load):
    """Run `load`, which dies before it takes the given step of its publication."""
    real = publishing._finish

    def dying(files, intent, before_step):
        def check(number):
            if number == step:
                raise Killed

        return real(files, intent, check)

    with monkeypatch.context() as patched:
        patched.setattr(publishing, "_finish", dying)
        with pytest.raises(Killed):
            load()


def _rows(store, table=FACTS):
    return sorted(tuple(r) for r in store.read(table).select("k", "v", "day").collect())


BEFORE = [("a", 1, D1), ("b", 1, D2)]
AFTER = [("a", 2, D3), ("b", 2, D1)]


@pytest.mark.parametrize("step", range(3))
def test_a_moved_trip_is_never_in_two_months(store, facts, spark, monkeypatch, step):
    """Both rows change their month: two folders are published, one goes."""
    store.upsert(FACTS, facts(*BEFORE))
    _killed_at(monkeypatch, step, lambda: store.upsert(FACTS, facts(*AFTER)))
    beside = TableStore(spark, store.root, read_only=True)
    assert not beside.recover(FACTS)
    again = TableStore(spark, store.root)
    assert _rows(again) == AFTER and again.partitions(FACTS) == [D1, D3]
    assert not again.recover(FACTS)
    # The next load goes on from there, and nothing is left lying about.
    again.upsert(FACTS, facts(("c", 3, D1)))
    assert _rows(again) == [*AFTER, ("c", 3, D1)]
    assert not [n for n in os.listdir(f"{store.root}/t") if "__stage" in n or "__intent" in n]


def test_dying_before_the_intent_changes_nothing(store, facts, spark, monkeypatch):
    store.upsert(FACTS, facts(*BEFORE))

    def dead(*args):
        raise Killed

    with monkeypatch.context() as patched:
        patched.setattr(publishing.Files, "write_text", dead)
        with pytest.raises(Killed):
            store.upsert(FACTS, facts(*AFTER))
    again = TableStore(spark, store.root)
    assert _rows(again) == BEFORE
    assert glob.glob(f"{store.root}/t/facts__stage_*")
    again.upsert(FACTS, facts(*AFTER))
    assert _rows(again) == AFTER and not glob.glob(f"{store.root}/t/facts__stage_*")


@pytest.mark.parametrize("step", range(2))
def test_replacing_and_emptying_partitions(store, facts, spark, monkeypatch, step):
    store.replace_partitions(FACTS, facts(*BEFORE), [D1, D2])
    load = lambda: store.replace_partitions(FACTS, facts(("x", 9, D1)), [D1, D2])
    _killed_at(monkeypatch, step, load)
    assert _rows(TableStore(spark, store.root)) == [("x", 9, D1)]


def test_a_whole_table(store, facts, spark, monkeypatch):
    store.overwrite(PLAIN, facts(*BEFORE))
    _killed_at(monkeypatch, 0, lambda: store.overwrite(PLAIN, facts(*AFTER)))
    assert _rows(TableStore(spark, store.root, read_only=True), PLAIN) == BEFORE
    assert _rows(TableStore(spark, store.root), PLAIN) == AFTER


def test_killed_between_deleting_and_moving(store, facts, spark, monkeypatch):
    store.overwrite(PLAIN, facts(*BEFORE))
    with monkeypatch.context() as patched:
        real = publishing.Files.rename

        def dead(self, source, target):
            if "__stage_" in source:
                raise Killed
            real(self, source, target)

        patched.setattr(publishing.Files, "rename", dead)
        with pytest.raises(Killed):
            store.overwrite(PLAIN, facts(*AFTER))
    assert not os.path.exists(store.path(PLAIN))
    assert _rows(TableStore(spark, store.root), PLAIN) == AFTER


def test_a_read_only_store_writes_nothing(store, facts, spark):
    store.upsert(FACTS, facts(*BEFORE))
    with pytest.raises(PermissionError):
        TableStore(spark, store.root, read_only=True).replace_partitions(FACTS, facts(), [D1])
    assert _rows(store) == BEFORE


def _pieces(store, facts, spark, n):
    for i in range(n):
        part = facts(*[(f"{i}-{j}", j, D1) for j in range(3)])
        part.coalesce(1).write.mode("append").partitionBy("day").parquet(store.path(FACTS))


def test_compaction_leaves_large_files_alone(store, facts, spark):
    _pieces(store, facts, spark, 6)
    large = facts(*[(f"large-{j}", j, D1) for j in range(5_000)])
    large.coalesce(1).write.mode("append").partitionBy("day").parquet(store.path(FACTS))
    alone = facts(("alone", 1, D2))
    alone.coalesce(1).write.mode("append").partitionBy("day").parquet(store.path(FACTS))
    files = lambda d: {f: Path(f).read_bytes() for f in glob.glob(f"{store.path(FACTS)}/day={d}/part-*")}
    before, first, second = _rows(store), files(D1), files(D2)
    limit = max(map(len, first.values())) - 1
    result = store.compact(FACTS, small_bytes=limit)
    after = files(D1)
    assert result.rows == 18 and result.partitions == (D1,) and _rows(store) == before
    assert len(after) == 2 and files(D2) == second
    assert [first[f] for f in after if f in first] == [max(first.values(), key=len)]
    assert store.compact(FACTS, small_bytes=limit).rows == 0


@pytest.mark.parametrize("step", (0, 1, 4))
def test_compaction_killed_half_way(store, facts, spark, monkeypatch, step):
    _pieces(store, facts, spark, 5)
    before = _rows(store)
    _killed_at(monkeypatch, step, lambda: store.compact(FACTS, [D1]))
    again = TableStore(spark, store.root)
    assert _rows(again) == before
    assert len(glob.glob(f"{store.path(FACTS)}/day={D1}/part-*")) == 1


def test_first_fit():
    files = [("p", f"f{i}", size) for i, size in enumerate([5, 4, 4, 3, 2, 1])] + [("q", "g", 1)]
    groups = packing.packed(files, 9)
    sizes = {f: s for _, f, s in files}
    assert sorted(sum(sizes[f] for _, f in g) for g in groups) == [9, 9]
    assert sum(map(len, groups)) == 5  # the last of p and that of q would be alone
    assert all(len({p for p, _ in g}) == 1 for g in groups)
