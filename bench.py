"""Times the headline queries and the stages of a load, and prints one JSON line.

BENCH_SF_DIR names the folder with the tables, BENCH_CPUS the local cores.
Entries named stage_* write tables as the monthly job does: all months of the
supplied tables are loaded through bronze, silver and gold.
"""

from __future__ import annotations

import json
import os
import re
import tempfile
import time
from collections.abc import Callable

from pyspark.sql import SparkSession

from tripmart import schemas
from tripmart.catalog.queries import REGISTERED
from tripmart.plans import bronze
from tripmart.plans.flow import Flow
from tripmart.sources import sample
from tripmart.store import TableStore

HEADLINES = (
    "bronze_conform",
    "silver_trips",
    "silver_monthly_batches",
    "dim_date",
    "fact_trips",
    "agg_hourly_metrics",
    "agg_zone_summary",
    "zone_summary_wide",
    "merge_upsert",
    "dq_report",
    "dq_unique",
    "layer_retention",
    "runlog_upsert",
)


def stages(spark: SparkSession, folder: str) -> dict[str, Callable[[], object]]:
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    zones = f"{root}/zones.parquet"
    sample.zone_source(spark, folder).write.parquet(zones)
    flow = Flow(TableStore(spark, f"{root}/store"), root, zones, central_borough="ASIA")
    flow.ingest_zones()
    flow.build_silver_zones()
    raw = bronze.stamped(bronze.conform_trips(sample.trip_source(spark, folder)))
    months = [r[0] for r in raw.select("partition_date").distinct().collect()]

    def ingest():
        flow.store.ensure(schemas.RAW_TRIPS)
        checked = bronze.enforce(raw, schemas.RAW_TRIPS)
        flow.store.replace_partitions(schemas.RAW_TRIPS, checked, months)

    return {
        "stage_ingest": ingest,
        "stage_validate": lambda: flow.validate_trips(months),
        "stage_silver_build": lambda: flow.build_silver_trips(months),
        "stage_gold_build": flow.build_gold,
        "stage_publish": lambda: flow.publish_trips(months[0]),
    }


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tripmart-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def query(name: str) -> Callable[[], object]:
        return lambda: (
            REGISTERED[name](spark, folder).write.format("noop").mode("overwrite").save()
        )

    # Start-up and compilation are not part of the timings.
    query("silver_trips")()
    jobs = {name: query(name) for name in HEADLINES} | stages(spark, folder)
    seconds = {}
    for name, job in jobs.items():
        started = time.perf_counter()
        job()
        seconds[name] = round(time.perf_counter() - started, 3)
    scale = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else folder,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
