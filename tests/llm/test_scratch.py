"""Tables between steps leave no shuffle files behind."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from llm.scratch import CLEANUP, Scratch


def _shuffled(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = files.mkString("\n").split("\n")
    return {n for n in names if "/shuffle_" in n}


def test_a_written_table_frees_what_it_shuffled(spark):
    before = _shuffled(spark)
    rows = spark.range(20_000).select(F.xxhash64("id").alias("k"), "id")
    held = rows.groupBy("k").agg(F.max("id").alias("id"))
    found = Scratch(spark, "freed").write(held)
    for _ in range(50):
        if not _shuffled(spark) - before:
            break
        time.sleep(0.1)
    assert not _shuffled(spark) - before
    # `held` itself can still be asked, by shuffling anew.
    assert found.count() == held.count() == 20_000


def test_the_session_keeps_its_setting(spark):
    before = spark.conf.get(CLEANUP, None)
    Scratch(spark, "setting").write(spark.range(3))
    assert spark.conf.get(CLEANUP, None) == before
