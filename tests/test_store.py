"""Loads, merges and the run log."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.errors import DuplicateKeys, SchemaChanged
from tripmart.operators import merge
from tripmart.catalog.queries import REGISTERED
from tripmart.runlog import FAILED, RUNNING, SUCCESS, RunLog, record
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
D1, D2, D3 = dt.date(2024, 1, 1), dt.date(2024, 2, 1), dt.date(2024, 3, 1)


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "store"))


@pytest.fixture
def facts(spark):
    return lambda *rows: spark.createDataFrame(list(rows), FACTS.schema)


def _rows(store, table=FACTS):
    return sorted(
        (tuple(r) for r in store.read(table).select("k", "v", "day").collect()), key=str
    )


def test_replacing_partitions(store, facts):
    store.ensure(FACTS)
    assert _rows(store) == []
    first = store.replace_partitions(FACTS, facts(("a", 1, D1), ("b", 2, D2)), [D1, D2])
    assert (first.rows, first.partitions) == (2, (D1, D2))
    again = store.replace_partitions(FACTS, facts(("c", 3, D1)), [D1])
    assert again.rows == 1
    assert _rows(store) == [("b", 2, D2), ("c", 3, D1)]
    empty = store.replace_partitions(FACTS, facts(), [D1])
    assert empty.rows == 0
    assert _rows(store) == [("b", 2, D2)]


def test_a_failing_load_changes_nothing(store, facts):
    store.replace_partitions(FACTS, facts(("a", 1, D1)), [D1])
    with pytest.raises(Exception, match="outside the named partitions"):
        store.replace_partitions(FACTS, facts(("x", 1, D1), ("y", 1, D2)), [D1])
    broken = facts(("x", 1, D1)).withColumn("v", F.raise_error(F.lit("no")).cast("int"))
    with pytest.raises(Exception):
        store.replace_partitions(FACTS, broken, [D1])
    with pytest.raises(Exception):
        store.overwrite(FACTS, broken)
    assert _rows(store) == [("a", 1, D1)]


def test_upserting_across_partitions(store, facts):
    assert store.upsert(FACTS, facts(("a", 1, D1), ("b", 2, D2), (None, 0, D2))).rows == 3
    store.upsert(FACTS, facts(("a", 9, D3), ("c", 3, D2), (None, 5, D2)))
    # a moved from the first month, which is now empty; NULL keys never match.
    assert _rows(store) == sorted(
        [("a", 9, D3), ("b", 2, D2), ("c", 3, D2), (None, 0, D2), (None, 5, D2)], key=str
    )
    assert store.partitions(FACTS) == [D2, D3]


def test_upsert_refuses(store, facts, spark):
    with pytest.raises(DuplicateKeys):
        store.upsert(FACTS, facts(("a", 1, D1), ("a", 2, D2)))
    with pytest.raises(SchemaChanged, match="extra"):
        store.upsert(FACTS, facts(("a", 1, D1)).withColumn("extra", F.lit(1)))
    with pytest.raises(Exception, match="must not be NULL"):
        store.upsert(FACTS, facts(("a", 1, None)))
    assert not store.exists(FACTS)


def test_overwriting_with_other_columns(store, spark):
    free = Table("t/free", None, keys=("id",))
    store.overwrite(free, spark.range(3))
    store.overwrite(free, spark.range(2).withColumn("x", F.lit("y")), allow_schema_change=True)
    assert store.read(free).columns == ["id", "x"] and store.read(free).count() == 2
    store.upsert(free, spark.range(1, 4).withColumn("x", F.lit("z")))
    assert sorted(map(tuple, store.read(free).collect())) == [(0, "y"), (1, "z"), (2, "z"), (3, "z")]


def test_compacting(store, spark):
    rows = spark.range(100).selectExpr("cast(id as string) k", "cast(id as int) v").withColumn(
        "day", F.when(F.col("v") < 90, F.lit(D1)).otherwise(F.lit(D2))
    )
    for part in range(4):
        piece = rows.filter(F.col("v") % 4 == part)
        piece.write.mode("append").partitionBy("day").parquet(store.path(FACTS))
    before = _rows(store)
    files = lambda: {
        d: store.read(FACTS, F.col("day") == d).select(F.input_file_name()).distinct().count()
        for d in (D1, D2)
    }
    many = files()
    result = store.compact(FACTS, [D1])
    assert result.rows == 90 and _rows(store) == before
    assert many[D1] >= 4 and files() == {D1: 1, D2: many[D2]}


def test_partition_filter_reaches_the_scan(store, facts):
    store.replace_partitions(FACTS, facts(("a", 1, D1), ("b", 2, D2)), [D1, D2])
    plan = store.read(FACTS, F.col("day") == D2)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_merge_with_several_keys(spark):
    target = spark.createDataFrame([(1, "a", 0), (1, "b", 0), (1, None, 0)], "x int, y string, v int")
    source = spark.createDataFrame([(1, "a", 1), (1, None, 1), (2, "a", 1)], "x int, y string, v int")
    got = sorted(map(str, (tuple(r) for r in merge.upserted(target, source, ["x", "y"]).collect())))
    want = [(1, "a", 1), (1, "b", 0), (1, None, 0), (1, None, 1), (2, "a", 1)]
    assert got == sorted(map(str, want))


def _record(status, **more):
    base = dict(
        run_id="scheduled__2024-01-01",
        dag_id="gold",
        task_id="load_fact_trips",
        started_at=dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc),
    )
    return record(status=status, **{**base, **more})


def test_run_log(store):
    log = RunLog(store)
    log.log(_record(RUNNING, partition_date=D1))
    log.log(
        _record(
            SUCCESS,
            rows_written=9_823_441,
            duration_seconds=142.3,
            delta_path="/lake",
            partition_date=D2,
            metadata={"parts": 8},
        )
    )
    row = log.read().collect()
    assert len(row) == 1
    # Only the listed columns follow the later record.
    assert (row[0].status, row[0].rows_written, row[0].delta_path) == ("success", 9823441, None)
    assert row[0].partition_date == D1 and row[0].metadata == '{"parts": 8}'
    assert str(row[0].duration_seconds) == "142.300"
    log.log(_record(FAILED, error_message="refused"))
    row = log.read().first()
    assert (row.status, row.error_message, row.rows_written) == ("failed", "refused", None)


def test_tracking(store, facts):
    log = RunLog(store)
    with log.track("gold", "load", D1) as results:
        results.append(store.upsert(FACTS, facts(("a", 1, D1))))
    with pytest.raises(ZeroDivisionError):
        with log.track("gold", "load", D2):
            1 / 0
    rows = {r.partition_date: r for r in log.read().collect()}
    assert (rows[D1].status, rows[D1].rows_written) == ("success", 1)
    assert (rows[D2].status, rows[D2].error_message) == ("failed", "division by zero")
    latest = log.latest(1).collect()
    assert [r.partition_date for r in latest] == [D2]


def test_random_upserts_against_a_dictionary(store, facts):
    import random

    rng = random.Random(5)
    model = {}
    for _ in range(4):
        keys = rng.sample("abcdefghij", rng.randrange(1, 8))
        batch = [(k, rng.randrange(100), rng.choice([D1, D2, D3])) for k in keys]
        store.upsert(FACTS, facts(*batch))
        model |= {k: (k, v, d) for k, v, d in batch}
        assert _rows(store) == sorted(model.values(), key=str)
        assert store.partitions(FACTS) == sorted({d for _, _, d in model.values()})


def test_a_stored_month_is_one_folder(spark):
    scan = REGISTERED["partition_scan"](spark, "/root/testdata/sf0.001")
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(partition_date" in plan
