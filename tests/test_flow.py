"""Whole runs on files."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tripmart import schemas
from tripmart.errors import RuleFailed
from tripmart.operators import quality
from tripmart.plans import monitor
from tripmart.plans.flow import Flow
from tripmart.sources import files
from tripmart.store import TableStore

from tests.conftest import HEADER, JANUARY, TWO_TRIPS

FEBRUARY, MARCH = dt.date(2024, 2, 1), dt.date(2024, 3, 1)
COLUMNS = HEADER.split(",")


@pytest.fixture
def deliver(spark, tmp_path):
    """Writes a month's file from CSV lines, replacing an earlier delivery."""
    root = tmp_path / "files"
    root.mkdir()

    def write(month, *lines):
        rows = [tuple(line.split(",")) for line in lines]
        text = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in COLUMNS))
        typed = text.selectExpr(
            "cast(VendorID as int) VendorID",
            "cast(tpep_pickup_datetime as timestamp_ntz) tpep_pickup_datetime",
            "cast(tpep_dropoff_datetime as timestamp_ntz) tpep_dropoff_datetime",
            *[f"cast(nullif({c}, '') as double) {c}" for c in COLUMNS[3:5]],
            *[f"cast(nullif({c}, '') as int) {c}" for c in COLUMNS[5:7]],
            *[f"cast({c} as double) {c}" for c in COLUMNS[7:]],
        )
        path = files.trip_path(str(root), month)
        typed.write.mode("overwrite").parquet(path)
        return path

    write.root = str(root)
    return write


@pytest.fixture
def flow(spark, deliver, zone_csv, tmp_path):
    return Flow(TableStore(spark, str(tmp_path / "store")), deliver.root, zone_csv)


def _in_month(line, month):
    return line.replace("2024-01-15", f"2024-{month:02d}-15")


def _silver(flow):
    rows = flow.store.read(schemas.SILVER_TRIPS).select("trip_id", "partition_date").collect()
    return sorted((r.partition_date, r.trip_id) for r in rows)


def test_a_month_end_to_end_and_again(flow, deliver):
    deliver(JANUARY, *TWO_TRIPS)
    flow.run([JANUARY])
    first = _silver(flow)
    assert len(first) == 2
    for table in (schemas.FACT_TRIPS, schemas.LAKE_TRIPS, schemas.AGG_ZONE, schemas.AGG_HOURLY):
        assert flow.store.read(table).count() == 2, table.name
    assert flow.store.read(schemas.LAKE_ZONES).count() == 4
    flow.test_gold()
    flow.run([JANUARY])
    assert _silver(flow) == first
    log = flow.log.read()
    assert {r.status for r in log.collect()} == {"success"}
    tasks = {(r.dag_id, r.task_id) for r in log.collect()}
    assert ("bronze", "ingest_trips") in tasks and ("gold", "load_fact_trips") in tasks


def test_backfill_equals_months_in_turn(flow, deliver):
    deliver(JANUARY, *TWO_TRIPS)
    # The first January trip is delivered once more in February.
    deliver(FEBRUARY, TWO_TRIPS[0], *[_in_month(t, 2) for t in TWO_TRIPS] * 40)
    bad = deliver(dt.date(2024, 4, 1), *TWO_TRIPS)
    assert flow.backfill(JANUARY, dt.date(2024, 4, 30), dry_run=True) == [
        JANUARY,
        FEBRUARY,
        MARCH,
        dt.date(2024, 4, 1),
    ]
    summary = flow.backfill(JANUARY, dt.date(2024, 4, 30))
    assert summary.succeeded == [JANUARY, FEBRUARY]
    assert set(summary.failed) == {MARCH, dt.date(2024, 4, 1)}, bad
    together = _silver(flow)
    assert [m for m, _ in together] == [JANUARY] + [FEBRUARY] * 81

    single = Flow(
        TableStore(flow.spark, flow.store.root + "-single"), deliver.root, flow.zones_path
    )
    single.ingest_trips(files.trip_paths(deliver.root, [JANUARY, FEBRUARY]))
    for month in (JANUARY, FEBRUARY):
        single.build_silver_trips([month])
    assert _silver(single) == together

    failed = monitor.failed_months(flow.log.read()).collect()
    assert [r.partition_date for r in failed] == [MARCH, dt.date(2024, 4, 1)]


def test_backfill_goes_on_after_bad_months(flow, deliver):
    spoilt = {
        1: [_in_month(t, 1) for t in TWO_TRIPS],
        2: [_in_month(TWO_TRIPS[0], 2).replace(",3.5,", ",99999999.0,")],
        3: [_in_month(TWO_TRIPS[0], 3).replace(",100,200,", ",,200,")],
        4: [_in_month(TWO_TRIPS[0], 4).replace(",100,200,", ",100,77,")],
        6: TWO_TRIPS,
    }
    for month, lines in spoilt.items():
        deliver(dt.date(2024, month, 1), *lines)
    summary = flow.backfill(JANUARY, dt.date(2024, 6, 30))
    assert summary.succeeded == [JANUARY]
    assert [m.month for m in sorted(summary.failed)] == [2, 3, 4, 5, 6]
    reasons = {m.month: text for m, text in summary.failed.items()}
    assert "1 rows with values that do not fit" in reasons[2]
    assert "1 with missing values" in reasons[3] and "1 zones" in reasons[4]
    for table in (schemas.SILVER_TRIPS, schemas.FACT_TRIPS, schemas.LAKE_TRIPS):
        assert flow.store.read(table).count() == 2, table.name
    failed = monitor.failed_months(flow.log.read()).collect()
    assert sorted(r.partition_date.month for r in failed) == [2, 3, 4, 5, 6]


def test_gold_is_tested_before_it_is_published(flow, deliver):
    deliver(JANUARY, TWO_TRIPS[0].replace(",2,3.5,", ",,3.5,"))
    with pytest.raises(RuleFailed, match="fact_trips_not_null"):
        flow.run([JANUARY])
    assert not flow.store.exists(schemas.LAKE_TRIPS)
    safe = Flow(flow.store, deliver.root, flow.zones_path, null_safe_keys=True)
    safe.run([JANUARY])
    assert flow.store.read(schemas.LAKE_TRIPS).count() == 1


def test_gate_and_watermark(flow, deliver):
    deliver(JANUARY, *TWO_TRIPS)
    deliver(FEBRUARY, *[_in_month(t, 2) for t in TWO_TRIPS])
    flow.ingest_trips(files.trip_paths(deliver.root, [FEBRUARY]))
    assert flow.build_silver_trips().rows == 2
    flow.ingest_trips(files.trip_paths(deliver.root, [JANUARY]))
    # January lies before the watermark; only naming it loads it.
    assert flow.build_silver_trips().rows == 0
    assert flow.build_silver_trips([JANUARY]).rows == 2
    deliver(JANUARY, TWO_TRIPS[0])
    flow.ingest_trips(files.trip_paths(deliver.root, [JANUARY]))
    flow.build_silver_trips([JANUARY])
    assert len(_silver(flow)) == 4
    flow.build_silver_trips([JANUARY], mode="replace_partition")
    assert len(_silver(flow)) == 3


def test_a_failed_gate_stops_the_run(flow, deliver):
    deliver(FEBRUARY, *TWO_TRIPS)
    with pytest.raises(RuleFailed, match="trips_pickup_within_partition_month"):
        flow.run([FEBRUARY])
    assert flow.store.read(schemas.RAW_TRIPS).count() == 2
    assert not flow.store.exists(schemas.SILVER_TRIPS)
    lenient = Flow(
        flow.store,
        deliver.root,
        flow.zones_path,
        trips_suite=lambda month: [quality.RAW_TRIPS_NOT_NULL],
    )
    assert lenient.validate_trips([FEBRUARY, MARCH])[FEBRUARY].success


def test_orphans_fail_the_silver_tests(flow, deliver):
    deliver(JANUARY, TWO_TRIPS[0].replace(",200,", ",77,"))
    with pytest.raises(RuleFailed, match="do_location_id"):
        flow.run([JANUARY])
    row = flow.log.read().filter(F.col("task_id") == "test_silver").first()
    assert row.status == "failed"


def test_a_second_backfill_reads_no_trip_file(flow, deliver, monkeypatch):
    for number in (1, 2, 3):
        deliver(dt.date(2024, number, 1), *[_in_month(t, number) for t in TWO_TRIPS])
    end = dt.date(2024, 3, 31)
    first = flow.backfill(JANUARY, end)
    assert (first.succeeded, first.unchanged) == ([JANUARY, FEBRUARY, MARCH], [])
    loaded, opened = _silver(flow), []
    real = files.open_source
    monkeypatch.setattr(
        files, "open_source", lambda spark, path: opened.append(path) or real(spark, path)
    )
    second = flow.backfill(JANUARY, end)
    assert (second.succeeded, second.unchanged, opened) == ([], [JANUARY, FEBRUARY, MARCH], [])
    # Another delivery of one month is loaded, and nothing else.
    deliver(FEBRUARY, *[_in_month(t, 2) for t in TWO_TRIPS], _in_month(TWO_TRIPS[0], 2).replace("14.5", "15.5"))
    third = flow.backfill(JANUARY, end)
    assert (third.succeeded, third.unchanged) == ([FEBRUARY], [JANUARY, MARCH])
    assert {p for p in opened if "tripdata" in p} == {files.trip_path(deliver.root, FEBRUARY)}
    assert len(_silver(flow)) == len(loaded) + 1
    assert flow.backfill(JANUARY, JANUARY, again=True).succeeded == [JANUARY]


def test_two_writers_of_the_run_log_lose_nothing(flow):
    """Each begins runs of its own while the other's are open; one folds the files meanwhile."""
    from tripmart.runlog import RUNNING, SUCCESS, RunLog, record

    at = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    logs = [RunLog(flow.store), RunLog(TableStore(flow.spark, flow.store.root))]

    def write(log, run, status, **more):
        log.log(record(run_id=run, dag_id="d", task_id="t", status=status, started_at=at, **more))

    for n in range(3):
        for i, log in enumerate(logs):
            write(log, f"{i}-{n}", RUNNING, delta_path="first", rows_written=1)
        if n == 1:
            assert logs[0].settle() == 6
        for i, log in enumerate(logs):
            write(log, f"{i}-{n}", SUCCESS, delta_path="second", error_message=None)
    want = {(f"{i}-{n}", "success", "first", None) for i in range(2) for n in range(3)}

    def found():
        return {(r.run_id, r.status, r.delta_path, r.rows_written) for r in logs[1].read().collect()}

    assert found() == want
    assert logs[1].settle() > 1 and found() == want and logs[0].settle() == 1


def test_rows_are_found_by_either_column_of_a_curve(spark, tmp_path):
    """After laying out along the curve, a filter on one column is met by few row groups."""
    import pyarrow.parquet as pq
    from pyspark.sql import types as T

    from tripmart.schemas import Table

    table = Table(
        "t/trips",
        T.StructType(
            [
                T.StructField("zone", T.ShortType()),
                T.StructField("hour", T.LongType()),
                T.StructField("month", T.DateType()),
            ]
        ),
        partition_by="month",
    )
    store = TableStore(spark, str(tmp_path / "curve"))
    rows = spark.range(64_000).selectExpr(
        "cast(id % 256 as smallint) zone", "(id * 7919) % 743 as hour", "date'2024-01-01' month"
    )
    store.overwrite(table, rows)
    store.cluster(table, ["zone", "hour"], [JANUARY], file_bytes=16 << 10, rows_per_group=1_000)
    assert store.read(table).count() == 64_000
    folder = tmp_path / "curve/t/trips/month=2024-01-01"
    groups = []
    for file in folder.glob("part-*"):
        meta = pq.ParquetFile(file).metadata
        for g in range(meta.num_row_groups):
            each = [meta.row_group(g).column(c).statistics for c in range(2)]
            groups.append([(s.min, s.max) for s in each])
    assert len(groups) >= 40
    for column, value in ((0, 100), (0, 3), (1, 400), (1, 700)):
        met = sum(g[column][0] <= value <= g[column][1] for g in groups)
        assert met <= 0.35 * len(groups), (column, value, met, len(groups))
