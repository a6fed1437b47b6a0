"""Runs registered queries in Spark and their SQL in DuckDB and compares all rows.

Usage: python tests/compare.py [folder] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _value(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    return v


def _bag(rows, names) -> tuple[list[str], Counter]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return (
        [names[i] for i in order],
        Counter(tuple(_value(row[i]) for i in order) for row in rows),
    )


def differences(spark_df, con, sql: str) -> list[str]:
    names, got = _bag([tuple(r) for r in spark_df.collect()], spark_df.columns)
    result = con.execute(sql)
    want_names = [d[0] for d in result.description]
    want_names, want = _bag(result.fetchall(), want_names)
    if names != want_names:
        return [f"columns {names} != {want_names}"]
    missing, extra = want - got, got - want
    found = []
    if missing or extra:
        found.append(f"{sum(missing.values())} rows missing, {sum(extra.values())} extra")
        found += [f"  missing {r}" for r in sorted(missing, key=str)[:2]]
        found += [f"  extra   {r}" for r in sorted(extra, key=str)[:2]]
    return found


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as e

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    oracle = e.oracle_sql()
    bad = 0
    for name, build in e.queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        started = time.time()
        try:
            df = build(spark, folder)
            found = differences(df, con, oracle[name]) if name in oracle else ["no SQL"]
            rows = df.count()
        except Exception as error:  # report and go on with the next query
            found, rows = [str(error)[:900]], -1
        bad += bool(found)
        print(f"{'BAD' if found else 'ok '} {name} rows={rows} {time.time() - started:.1f}s")
        for line in found:
            print("    ", line)
    print("bad:", bad)
