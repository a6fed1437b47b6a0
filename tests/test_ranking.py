"""Row numbers of hot groups against the plain window."""

from __future__ import annotations

import glob
import os
import random
from collections import Counter

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tripmart.operators import ranking
from tripmart.operators.ranking import numbered


@pytest.fixture(scope="module")
def skewed(spark):
    """One group with half of all rows, many of them copies; NULLs in group and order."""
    rng = random.Random(3)
    rows = [(1, rng.randrange(40), "x") for _ in range(400)]
    rows += [(1, 7, "copy")] * 300
    rows += [(None, rng.choice([None, 1, 2]), "n") for _ in range(200)]
    rows += [(rng.randrange(2, 200), rng.randrange(5), "s") for _ in range(500)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "g int, o int, rest string").repartition(7)


def _bag(df):
    return Counter(tuple(r) for r in df.select("g", "o", "rest", "n").collect())


@pytest.mark.parametrize("copies_per_task", [1, 7, 300, 10_000])
def test_hot_groups_get_the_same_numbers(skewed, copies_per_task):
    plain = skewed.withColumn(
        "n", F.row_number().over(Window.partitionBy("g").orderBy("o", "rest"))
    )
    cut = numbered(
        skewed,
        ["g"],
        ["o"],
        "n",
        hot_rows=50,
        copies_per_task=copies_per_task,
    )
    assert cut.schema["n"].dataType.simpleString() == "bigint"
    assert _bag(cut) == _bag(plain)


def test_every_group_hot_or_none(skewed):
    all_hot = numbered(skewed, ["g"], ["o"], "n", hot_rows=1)
    none_hot = numbered(skewed, ["g"], ["o"], "n", hot_rows=10**9)
    assert _bag(all_hot) == _bag(none_hot)


def test_known_bound_skips_the_probe(skewed, monkeypatch):
    def fail(*_):
        raise AssertionError("probed")

    monkeypatch.setattr("tripmart.operators.ranking._hot_groups", fail)
    assert numbered(skewed, ["g"], ["o"], "n", rows_at_most=1400).count() == 1400


def test_two_group_columns(spark):
    rows = [(i % 2, "a" if i % 3 else None, i % 11) for i in range(600)]
    df = spark.createDataFrame(rows, "g int, h string, o int")
    window = Window.partitionBy("g", "h").orderBy("o")
    plain = df.withColumn("n", F.row_number().over(window))
    cut = numbered(df, ["g", "h"], ["o"], "n", hot_rows=20)
    assert Counter(map(tuple, cut.select("g", "h", "o", "n").collect())) == Counter(
        map(tuple, plain.select("g", "h", "o", "n").collect())
    )


def test_any_number_of_hot_groups(spark):
    many = spark.range(15_000).selectExpr("id % 5000 as g", "id as o")
    cut = numbered(many, ["g"], ["o"], "n", hot_rows=2)
    counts = sorted(map(tuple, cut.groupBy("n").count().collect()))
    assert counts == [(1, 5000), (2, 5000), (3, 5000)]


@pytest.mark.parametrize("tracked", [2, 16])
def test_no_hot_group_is_missed(spark, tracked, monkeypatch):
    """Many groups just below the bound arrive before, between and after those at it."""
    monkeypatch.setattr(ranking, "TRACKED_PER_HOT", max(8, tracked))
    hot_rows, hot = 300, [7, 1_000_003, -5]
    rows = []
    for wave in range(10):
        rows += [(g,) for g in hot for _ in range(30)]
        rows += [(10_000 * wave + i,) for i in range(2_000)]
        rows += [(500_000 + i % 40,) for i in range(1_100)]  # 275 rows each in all
    df = spark.createDataFrame(rows, "g long").coalesce(3)
    found = {r[0] for r in ranking._hot_groups(df, ["g"], hot_rows).collect()}
    want = {r[0] for r in spark.createDataFrame([(g,) for g in hot], "g long").select(F.xxhash64("g")).collect()}
    assert want <= found and len(found) <= 43


def test_too_many_groups_are_counted_one_by_one(spark, monkeypatch):
    monkeypatch.setattr(ranking, "MOST_TRACKED", 100)
    df = spark.range(1_000).selectExpr("id % 90 as g")
    # 1000 = 11 * 90 + 10: ten groups hold twelve rows.
    assert ranking._hot_groups(df, ["g"], 12).count() == 10


def test_the_source_is_evaluated_once(spark, tmp_path):
    """What lies at the source afterwards does not matter any more."""
    path = str(tmp_path / "source")
    spark.range(900).selectExpr("id % 3 as g", "id as o").write.parquet(path)
    cut = numbered(spark.read.parquet(path), ["g"], ["o"], "n", hot_rows=100)
    for file in glob.glob(f"{path}/part-*"):
        os.remove(file)
    assert cut.agg(F.max("n"), F.count("n")).first() == (300, 900)
