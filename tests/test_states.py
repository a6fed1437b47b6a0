"""Aggregates kept up by month, and checks of what has changed, against full ones."""

from __future__ import annotations

import datetime as dt
import glob
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.conftest import HEADER, JANUARY, TWO_TRIPS, write_lines
from tests.test_flow import FEBRUARY, MARCH, _in_month, deliver, flow  # noqa: F401
from tripmart import schemas
from tripmart.errors import RuleFailed
from tripmart.operators import changes, quality
from tripmart.plans import gold, states
from tripmart.sources import files

assert HEADER


def _bag(df):
    return sorted(map(str, (tuple(r) for r in df.select(*sorted(df.columns)).collect())))


def _load(flow, months):
    flow.ingest_trips(files.trip_paths(flow.trips_root, months))
    flow.build_silver_trips(months, mode="replace_partition")


def _spoil(flow, month):
    folder = f"{flow.store.path(schemas.SILVER_TRIPS)}/partition_date={month}"
    for file in glob.glob(f"{folder}/part-*"):
        Path(file).write_bytes(b"not a table")
        Path(file).with_name(f".{Path(file).name}.crc").unlink(missing_ok=True)


@pytest.fixture
def three_months(flow, deliver):  # noqa: F811
    for number, month in enumerate((JANUARY, FEBRUARY, MARCH), start=1):
        deliver(month, *[_in_month(t, number) for t in TWO_TRIPS])
    flow.run([JANUARY, FEBRUARY, MARCH])
    return flow


def test_aggregates_equal_a_full_rebuild(three_months, deliver):  # noqa: F811
    flow = three_months  # noqa: F811
    store = flow.store
    other = _in_month(TWO_TRIPS[0], 2).replace(",100,200,", ",250,150,").replace("08:00", "07:30")
    deliver(FEBRUARY, _in_month(TWO_TRIPS[1], 2), other)
    _load(flow, [FEBRUARY])
    assert flow.hours.stale() == flow.destinations.stale() == [FEBRUARY]
    trips = store.read(schemas.SILVER_TRIPS)
    dates, zones = gold.dim_date(trips), store.read(schemas.DIM_ZONE)
    measured = gold.trip_measures(trips)
    want = [_bag(gold.agg_hourly_metrics(measured, dates, zones)), _bag(gold.agg_zone_summary(measured, zones))]
    # Months that did not change cannot be read, and are not.
    _spoil(flow, JANUARY)
    _spoil(flow, MARCH)
    flow.refresh_aggregates()
    got = [_bag(store.read(t)) for t in (schemas.AGG_HOURLY, schemas.AGG_ZONE)]
    assert got == want


def test_a_month_that_is_gone(three_months, deliver):  # noqa: F811
    flow = three_months  # noqa: F811
    none = flow.store.read(schemas.SILVER_TRIPS).limit(0)
    flow.store.replace_partitions(schemas.SILVER_TRIPS, none, [MARCH])
    flow.refresh_aggregates()
    months = {r.trip_month for r in flow.store.read(schemas.AGG_ZONE).collect()}
    assert months == {"2024-01", "2024-02"}
    assert flow.store.partitions(flow.hours.table) == [JANUARY, FEBRUARY]


def test_destinations_of_any_number(spark):
    zones = spark.createDataFrame([(z,) for z in (1, 2, 300, 32_767, 0, -5)], "zone_key smallint")
    pairs = [(7, z) for z in (1, 2, 2, 300, 32_767, 0, -5)] + [(8, 1), (8, 999), (8, -1), (8, None), (9, None)]
    trips = spark.createDataFrame(
        [(p, d, dt.date(2024, 1 + i % 2, 1)) for i, (p, d) in enumerate(pairs)],
        "pu_location_id smallint, do_location_id smallint, partition_date date",
    )
    merged = states.merged_destinations(states.destinations(trips))
    got = {r[0]: r[1] for r in states.counted(merged, zones).collect()}
    # Unknown zones and absent ones are one destination together.
    assert got == {7: 6, 8: 2, 9: 1}
    by_month = states.merged_destinations(states.destinations(trips), "partition_date")
    assert states.counted(by_month, zones, "partition_date").count() == 5


def test_months_with_zones(three_months):
    flow = three_months  # noqa: F811
    find = lambda *z: sorted(
        r[0] for r in states.months_with_zones(flow.hours.read(), flow.destinations.read(), list(z)).collect()
    )
    assert find(200) == find(100) == [JANUARY, FEBRUARY, MARCH] and find(77, 5) == []


def test_only_changed_trips_are_checked(three_months, deliver):  # noqa: F811
    flow = three_months  # noqa: F811
    assert changes.Verified(flow.store, schemas.SILVER_TRIPS).changed() == []
    deliver(MARCH, *[_in_month(t, 3) for t in TWO_TRIPS], _in_month(TWO_TRIPS[0], 3).replace("14.50", "15.50"))
    _load(flow, [MARCH])
    assert changes.Verified(flow.store, schemas.SILVER_TRIPS).changed() == [MARCH]
    _spoil(flow, JANUARY)
    _spoil(flow, FEBRUARY)
    flow.test_silver()
    with pytest.raises(Exception):
        flow.test_silver(everything=True)


def _verdict(flow, **how):  # noqa: F811
    try:
        flow.test_silver(**how)
    except RuleFailed as failed:
        return str(failed)
    return None


def _with_copy(flow, month, of, **changed):  # noqa: F811
    """A month with a further row, made of another month's first row."""
    trips = flow.store.read(schemas.SILVER_TRIPS)
    one = trips.filter(F.col("partition_date") == of).limit(1)
    one = one.withColumns({"partition_date": F.lit(month), **changed})
    own = trips.filter(F.col("partition_date") == month)
    rows = flow.spark.createDataFrame(own.unionByName(one).collect(), trips.schema)
    flow.store.replace_partitions(schemas.SILVER_TRIPS, rows, [month])


def test_same_verdict_on_planted_violations(three_months):
    flow = three_months  # noqa: F811
    plants = {
        "key of another month": (FEBRUARY, {}),
        "key of the same month": (MARCH, {}),
        "orphan": (JANUARY, {"trip_id": F.lit("x"), "do_location_id": F.lit(77).cast("smallint")}),
        "null": (JANUARY, {"trip_id": F.lit(None).cast("string")}),
        "order of times": (JANUARY, {"trip_id": F.lit("y"), "trip_duration_minutes": F.lit(0).cast(schemas.MINUTES)}),
    }
    clean = flow.spark.createDataFrame(
        flow.store.read(schemas.SILVER_TRIPS).collect(), schemas.SILVER_TRIPS.schema
    )
    for name, (of, changed) in plants.items():
        _with_copy(flow, MARCH, of, **changed)
        narrow, full = _verdict(flow), _verdict(flow, everything=True)
        assert narrow == full and narrow, name
        own = clean.filter(F.col("partition_date") == MARCH)
        flow.store.replace_partitions(schemas.SILVER_TRIPS, own, [MARCH])
    assert _verdict(flow) is None


def test_a_zone_that_goes_makes_orphans_of_old_trips(three_months, tmp_path):
    flow = three_months  # noqa: F811
    lines = Path(flow.zones_path).read_text().splitlines()
    for gone in ("200", "100"):
        flow.zones_path = write_lines(tmp_path / f"z{gone}.csv", [x for x in lines if not x.startswith(gone)])
        flow.ingest_zones()
        flow.build_silver_zones()
        assert changes.Verified(flow.store, schemas.SILVER_TRIPS).changed() == []
        narrow, full = _verdict(flow), _verdict(flow, everything=True)
        assert narrow == full and "location_id" in narrow
    # An unused zone may go.
    flow.zones_path = write_lines(tmp_path / "all.csv", lines + ["263,Queens,Nowhere,Boro Zone"])
    flow.ingest_zones()
    flow.build_silver_zones()
    flow.test_silver()
    flow.zones_path = write_lines(tmp_path / "back.csv", lines)
    flow.ingest_zones()
    flow.build_silver_zones()
    flow.test_silver()


def test_gate_rows(spark):
    rows = spark.createDataFrame([("a", True, 0), ("b", False, 3)], "rule string, success boolean, failure_count int")
    assert tuple(quality.gate(rows).first()) == (False, 1, 3)
