"""Loads that make and write their rows once."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import JANUARY
from tripmart import schemas, store as stores
from tripmart.catalog import stored
from tripmart.errors import DuplicateKeys
from tripmart.operators import ranking
from tripmart.operators.publishing import Files
from tripmart.store import TableStore

JUNE = dt.date(1997, 6, 1)


@pytest.fixture
def tips(spark, monkeypatch):
    """Trips whose ids are others each time they are made."""
    months = [dt.date(1995, 3, 1), dt.date(1997, 2, 1), JUNE]
    rows = spark.range(30).select(
        F.expr("uuid()").alias("trip_id"),
        (F.col("id") * 200).cast(schemas.MONEY).alias("tip_amount"),
        (F.col("id") > 0).alias("has_tip"),
        F.element_at(F.array(*[F.lit(m) for m in months]), (F.col("id") % 3 + 1).cast("int")).alias("partition_date"),
    )
    monkeypatch.setattr(stored, "_silver", lambda spark, folder: rows)


def test_a_repeated_delivery_finds_the_stored_trips(spark, tips):
    merged = stored.upsert_stored(spark, "").groupBy("partition_date").count().collect()
    moved = {dt.date(1995, 3, 1): 10, dt.date(1997, 4, 1): 10, dt.date(1997, 8, 1): 10}
    assert {r[0]: r[1] for r in merged} == moved


def test_keys_looked_up_are_the_stored_ones(spark, tips):
    found = stored.key_index_lookup(spark, "").collect()
    assert {r["partition_date"]: r["trips"] for r in found} == {dt.date(1997, 2, 1): 10, JUNE: 10}


def test_repeated_keys_are_those_of_stored_months(spark, tips):
    # Of June, ids over 15 are sent twice; of 1995, those with a tip are there already.
    found = stored.dq_unique_changed(spark, "").collect()
    assert len(found) == 9 + len([i for i in range(2, 30, 3) if i > 15])
    assert {r["n"] for r in found} == {2}


def _silver(raw_trip, *rows):
    from tripmart.plans import silver, staging

    trips = staging.trips(raw_trip(*rows)).withColumn("ingested_at", F.localtimestamp())
    return silver.stored(silver.stamped(silver.trips(trips)))


def test_a_first_load_is_written_once(spark, tmp_path, raw_trip, monkeypatch):
    def never(df):
        raise AssertionError("written twice")

    monkeypatch.setattr(stores, "staged_meanwhile", never)
    store = TableStore(spark, str(tmp_path / "store"))
    rows = _silver(raw_trip, {}, {"pu_location_id": 150})
    done = store.upsert(schemas.SILVER_TRIPS, rows)
    assert (done.rows, done.partitions) == (2, (JANUARY,))
    assert store.read(schemas.SILVER_TRIPS).count() == 2
    assert store.key_index(schemas.SILVER_TRIPS).stale() == []


def test_a_first_load_with_repeated_keys_leaves_nothing(spark, tmp_path, raw_trip):
    store = TableStore(spark, str(tmp_path / "store"))
    rows = _silver(raw_trip, {})
    with pytest.raises(DuplicateKeys, match="2 source rows share trip_id"):
        store.upsert(schemas.SILVER_TRIPS, rows.unionByName(rows))
    assert store.partitions(schemas.SILVER_TRIPS) == []
    assert not [n for n in Files(spark).names(f"{tmp_path}/store/silver") if "stage" in n]


def test_stored_rows_are_not_written_again_to_be_numbered(spark, tmp_path, monkeypatch):
    path, staged, sizes = str(tmp_path / "rows"), ranking.staged, []
    rows = spark.range(900).select((F.col("id") % 7 % 4).alias("g"), (F.col("id") * 7 % 31).alias("v"), "id")
    rows.write.parquet(path)
    source = spark.read.parquet(path)
    plain = F.row_number().over(Window.partitionBy("g").orderBy("v", "id")).cast("bigint")
    want = sorted(map(tuple, source.withColumn("n", plain).collect()))

    def watched(df):
        sizes.append(set(df.columns) >= {"g", "v", "id"} and "_copies" not in df.columns)
        return staged(df)

    monkeypatch.setattr(ranking, "staged", watched)
    how = dict(stored=True, in_ranges=True)
    for hot_rows in (200, 1_000_000):
        got = ranking.numbered(source, ["g"], ["v"], "n", hot_rows=hot_rows, **how)
        assert sorted(map(tuple, got.collect())) == want
    assert not any(sizes)


def test_ranges_keep_months_in_few_files(spark, tmp_path):
    rows = spark.range(4_000).select(F.col("id").alias("t"), F.floor(F.col("id") / 400).alias("month"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        mixed = rows.repartition(8)
        numbered = ranking.numbered(mixed, ["t"], ["month"], rows_at_most=4_000, in_ranges=True)
        numbered.write.partitionBy("month").parquet(str(tmp_path / "out"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    # Ten months over four tasks.
    assert len(list((tmp_path / "out").rglob("part-*.parquet"))) <= 13
