"""The monthly job: files to bronze, silver, gold and the lake tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart import schemas
from tripmart.errors import RuleFailed, TripmartError
from tripmart.operators import changes, merge, quality
from tripmart.operators.incremental import in_partitions, past
from tripmart.plans import bronze, gold, months, silver, staging, states
from tripmart.runlog import FAILED, SUCCESS, RunLog, record
from tripmart.sources import files
from tripmart.store import LoadResult, TableStore


# The task under which the run log holds months that went through all layers of a backfill.
_MONTH_TASK = "load_month"


@dataclass
class BackfillSummary:
    """Months that went through, why others did not, and those that were loaded before as they are."""

    succeeded: list[dt.date] = field(default_factory=list)
    failed: dict[dt.date, str] = field(default_factory=dict)
    unchanged: list[dt.date] = field(default_factory=list)


class Flow:
    """Loads months into the tables of a store, layer by layer.

    Several months are one Spark job per layer; the outcome is that of loading
    them one after another.
    """

    def __init__(
        self,
        store: TableStore,
        trips_root: str,
        zones_path: str,
        *,
        seed_path: str | None = None,
        central_borough: str = "Manhattan",
        trips_suite: Callable[[Column | str | None], Sequence[quality.Rule]] | None = None,
        null_safe_keys: bool = False,
    ):
        if store.spark.conf.get("spark.sql.ansi.enabled") != "true":
            raise ValueError("set spark.sql.ansi.enabled, so that misfit values stop a load")
        self.store = store
        self.spark = store.spark
        self.log = RunLog(store)
        self.trips_root = trips_root
        self.zones_path = zones_path
        self.seed_path = seed_path or zones_path
        self.central = central_borough
        self.trips_suite = trips_suite or quality.raw_trips_suite
        # Trips without a passenger count get no trip_key unless keys are null-safe.
        self.null_safe_keys = null_safe_keys
        self.hours = states.hours_of(store, schemas.SILVER_TRIPS)
        self.destinations = states.destinations_of(store, schemas.SILVER_TRIPS)

    # Bronze

    def ingest_trips(self, paths: dict[dt.date, str]) -> LoadResult:
        """Replace each month by the rows of its file.

        Files are typed one by one, as their physical types may differ, and
        written in one job.
        """
        typed = [
            bronze.conform_trips(files.read_trips(self.spark, path, month))
            for month, path in paths.items()
        ]
        batch = bronze.stamped(reduce(DataFrame.unionByName, typed))
        self.store.ensure(schemas.RAW_TRIPS)
        return self.store.replace_partitions(
            schemas.RAW_TRIPS,
            bronze.enforce(batch, schemas.RAW_TRIPS),
            list(paths),
            # A file is of one month, so its parts go to that month's folder as they are; those
            # of a text file may be many and small.
            together=all(path.endswith(".parquet") for path in paths.values()),
        )

    def ingest_zones(self) -> LoadResult:
        zones = bronze.stamped(bronze.conform_zones(files.read_zones(self.spark, self.zones_path)))
        merge.require_unique(zones, schemas.RAW_ZONES.keys, schemas.RAW_ZONES.name)
        return self.store.overwrite(schemas.RAW_ZONES, bronze.enforce(zones, schemas.RAW_ZONES))

    def validate_trips(
        self,
        wanted: Sequence[dt.date] | None = None,
        suite: Sequence[quality.Rule] | None = None,
    ) -> dict[dt.date | None, quality.QualityReport]:
        """A report per month; a month without rows passes.

        Without `wanted`, one report of the whole table, under None.
        """
        raw, table = self.store.read(schemas.RAW_TRIPS), schemas.RAW_TRIPS.name
        if wanted is None:
            return {None: quality.run(raw, suite or self.trips_suite(None), table)}
        rules = suite or self.trips_suite("partition_date")
        found = quality.run_by_month(in_partitions(raw, wanted), rules, table)
        return {m: found.get(m) or quality.QualityReport(table, m, ()) for m in wanted}

    def validate_zones(
        self, suite: Sequence[quality.Rule] = quality.RAW_ZONES_SUITE
    ) -> quality.QualityReport:
        return quality.run(self.store.read(schemas.RAW_ZONES), suite, schemas.RAW_ZONES.name)

    # Silver

    def build_silver_trips(
        self, wanted: Sequence[dt.date] | None = None, mode: str = "merge"
    ) -> LoadResult:
        """Add trips to silver.

        Without `wanted`, everything past silver's high watermark is one batch.
        Named months are loaded again whatever the watermark, by `merge` on the
        trip id, or by `replace_partition`, which also removes rows that are gone.
        """
        self.store.ensure(schemas.SILVER_TRIPS)
        raw = self.store.read(schemas.RAW_TRIPS)
        if wanted is None:
            raw = past(raw, max(self.store.partitions(schemas.SILVER_TRIPS), default=None))
        else:
            raw = in_partitions(raw, wanted)
        in_turn = wanted is not None and len(wanted) > 1
        build = silver.monthly_batches if in_turn else silver.trips
        # A merge brings rows together itself, unless there is nothing to merge with.
        as_built = mode != "merge" or not self.store.partitions(schemas.SILVER_TRIPS)
        # Counting reads file footers only.
        built = build(
            staging.kept(raw),
            by_time=as_built,
            rows_at_most=raw.count(),
            stored=True,
        )
        built = silver.stored(silver.stamped(staging.timed(built)))
        if mode == "merge":
            return self.store.upsert(schemas.SILVER_TRIPS, built, together=as_built)
        if mode == "replace_partition":
            if wanted is None:
                raise ValueError("replace_partition needs the months to replace")
            return self.store.replace_partitions(
                schemas.SILVER_TRIPS, built, wanted, together=as_built
            )
        raise ValueError(f"unknown mode {mode}")

    def build_silver_zones(self) -> LoadResult:
        staged = staging.zones(self.store.read(schemas.RAW_ZONES))
        zones = silver.stamped(silver.zones(staged, self.central))
        return self.store.overwrite(schemas.SILVER_ZONES, zones)

    def test_silver(self, everything: bool = False) -> None:
        """Raise at the first silver rule that does not hold.

        Trips are tested where they have changed since all rules last held, keys also against
        all other months, by the key index.  A zone that has gone makes orphans of months loaded long ago:
        the states of these months tell which.  With `everything`, all trips are read.
        """
        store, table = self.store, schemas.SILVER_TRIPS
        verified = changes.Verified(store, table)
        months = store.partitions(table) if everything else verified.changed()
        trips = in_partitions(store.read(table), months)
        zones = store.read(schemas.SILVER_ZONES)
        for frame, suite, of in (
            (trips, quality.SILVER_TRIPS_SUITE, table),
            (zones, quality.SILVER_ZONES_SUITE, schemas.SILVER_ZONES),
        ):
            quality.require(quality.run(frame, suite, of.name))
        repeated = changes.repeated_keys(store, table, months)
        _require_none(repeated, "silver_trips_trip_id_unique")
        _require_none(quality.unique(zones, "location_id"), "silver_zones_location_id_unique")
        # A lookup of as many rows as a short number has values, at most.
        present = [r[0] for r in zones.select("location_id").collect()]
        gone = [] if everything else verified.removed("zones", present)
        if gone:
            months = sorted({*months, *self._months_with_zones(gone)})
            trips = in_partitions(store.read(table), months)
        for column in ("pu_location_id", "do_location_id"):
            orphans = quality.relationships(trips, column, zones, "location_id")
            _require_none(orphans, f"silver_trips_{column}_in_zones")
        verified.note({"zones": present})

    def _months_with_zones(self, zone_ids: list[int]) -> list[dt.date]:
        self._refresh_states()
        found = states.months_with_zones(self.hours.read(), self.destinations.read(), zone_ids)
        return [r[0] for r in found.collect()]

    def _refresh_states(self) -> None:
        """Bring the states of silver's months up to date; only months that differ are read."""
        self.hours.refresh()
        self.destinations.refresh()

    # Gold

    def build_gold(self) -> dict[str, LoadResult]:
        """Rebuild the star schema from silver, and its aggregates from the states of its months."""
        store = self.store
        self._refresh_states()
        trips = store.read(schemas.SILVER_TRIPS)
        seed = files.read_zone_seed(self.spark, self.seed_path)
        done = {}

        def save(table: schemas.Table, df: DataFrame, **how) -> DataFrame:
            done[table.name] = store.overwrite(table, df, **how)
            return store.read(table)

        hours = self.hours.read()
        dates = save(schemas.DIM_DATE, gold.laid_out(states.dim_date(hours), "dim_date"))
        zones = gold.laid_out(gold.dim_zone(seed, self.central), "dim_zone")
        zones = save(schemas.DIM_ZONE, zones)
        vendors = save(schemas.DIM_VENDOR, gold.dim_vendor(self.spark))
        built = gold.fact_trips(
            trips,
            dates,
            zones,
            vendors,
            self.null_safe_keys,
            by_time=True,
            rows_at_most=trips.count(),
            stored=True,
        )
        types = {f.name: f.dataType for f in schemas.FACT_TRIPS.schema}
        built = built.select(*[F.col(c).cast(t).alias(c) for c, t in types.items()])
        save(schemas.FACT_TRIPS, built, together=True)
        return done | self._aggregates(dates, zones)

    def refresh_aggregates(self) -> dict[str, LoadResult]:
        """Bring the aggregates up to date after months were loaded; facts are left alone.

        Of trips, only months that differ from those summed up before are read.
        """
        self._refresh_states()
        dates = states.dim_date(self.hours.read())
        return self._aggregates(dates, self.store.read(schemas.DIM_ZONE))

    def _aggregates(self, dates: DataFrame, zones: DataFrame) -> dict[str, LoadResult]:
        hours = self.hours.read()
        hourly = states.hourly_metrics(hours, dates, zones)
        by_zone = states.zone_summary(hours, self.destinations.read(), zones)
        return {
            table.name: self.store.overwrite(table, gold.laid_out(df, order))
            for table, df, order in (
                (schemas.AGG_HOURLY, hourly, "agg_hourly_metrics"),
                (schemas.AGG_ZONE, by_zone, "agg_zone_summary"),
            )
        }

    def test_gold(self) -> None:
        """Raise at the first gold rule that does not hold."""
        tables = {
            "dim_date": schemas.DIM_DATE,
            "dim_zone": schemas.DIM_ZONE,
            "dim_vendor": schemas.DIM_VENDOR,
            "fact_trips": schemas.FACT_TRIPS,
            "agg_hourly_metrics": schemas.AGG_HOURLY,
            "agg_zone_summary": schemas.AGG_ZONE,
        }
        frames = {name: self.store.read(table) for name, table in tables.items()}
        for name, rule in quality.GOLD_NOT_NULL.items():
            rules = [rule, quality.DIM_ZONE_BOROUGH] if name == "dim_zone" else [rule]
            quality.require(quality.run(frames[name], rules, tables[name].name))
        for name, table in tables.items():
            if table.keys:
                _require_none(quality.unique(frames[name], *table.keys), f"{name}_key_unique")
        orphans = quality.relationships(
            frames["fact_trips"], "date_key", frames["dim_date"], "date_key"
        )
        _require_none(orphans, "fact_trips_date_key_in_dim_date")

    def publish_trips(self, month: dt.date) -> LoadResult:
        """Merge one month of silver trips into the lake table."""
        one = in_partitions(self.store.read(schemas.SILVER_TRIPS), [month])
        return self.store.upsert(schemas.LAKE_TRIPS, gold.published(one), together=True)

    def publish_zones(self) -> LoadResult:
        zones = self.store.read(schemas.SILVER_ZONES)
        return self.store.overwrite(schemas.LAKE_ZONES, zones, allow_schema_change=True)

    # Whole runs

    def run(self, wanted: Sequence[dt.date]) -> None:
        """Load months through all layers; stops at the first error."""
        wanted = sorted({m.replace(day=1) for m in wanted})
        self._bronze(files.trip_paths(self.trips_root, wanted))
        for report in self.validate_trips(wanted).values():
            quality.require(report)
        self._silver_and_gold(wanted)

    def backfill(
        self, start: dt.date, end: dt.date, dry_run: bool = False, again: bool = False
    ) -> list[dt.date] | BackfillSummary:
        """Load all months of a range; months with bad input are reported and left out.

        Months whose file an earlier backfill has loaded as it is now are left alone, unless
        `again`: the run log keeps what files looked like.

        A missing or malformed file, a value that does not fit its type, a NULL where none may
        be, a zone that does not exist, or a rule that does not hold costs only its month.  A dry
        run only returns the months.
        """
        wanted = months.month_list(self.spark, start, end)
        if dry_run:
            return wanted
        summary = BackfillSummary()
        usable = {}
        paths = files.trip_paths(self.trips_root, wanted)
        prints = {m: files.fingerprint(self.spark, path) for m, path in paths.items()}
        known = {} if again else self._loaded_before()
        summary.unchanged = [m for m in wanted if prints[m] and known.get(m) == prints[m]]
        for month, path in paths.items():
            if month in summary.unchanged:
                continue
            try:
                usable[month] = files.read_trips(self.spark, path, month, strict=False)
            except TripmartError as error:
                summary.failed[month] = str(error)
        summary.failed |= self._misfits(usable)
        usable = {m: files.trip_path(self.trips_root, m) for m in usable if m not in summary.failed}
        if usable:
            self._bronze(usable)
            for month, report in self.validate_trips(list(usable)).items():
                if report.success:
                    summary.succeeded.append(month)
                else:
                    bad = report.failed[0]
                    summary.failed[month] = str(RuleFailed(bad.rule, bad.failure_count))
        self._log_failed(summary.failed)
        if summary.succeeded:
            self._silver_and_gold(summary.succeeded)
            self._log_months(summary.succeeded, SUCCESS, lambda m: {"source": prints[m]})
        return summary

    def _loaded_before(self) -> dict[dt.date, str]:
        """Fingerprints of the files that backfills have loaded through all layers; one per month."""
        done = self.log.read().filter(F.col("task_id") == _MONTH_TASK)
        done = done.filter(F.col("status") == SUCCESS)
        source = F.get_json_object("metadata", "$.source").alias("source")
        rows = done.select("partition_date", "finished_at", source).groupBy("partition_date")
        latest = rows.agg(F.max_by("source", "finished_at").alias("source"))
        return {r["partition_date"]: r["source"] for r in latest.collect()}

    def _log_months(
        self, which: Sequence[dt.date], status: str, metadata: Callable[[dt.date], dict]
    ) -> None:
        now = dt.datetime.now(dt.timezone.utc)
        self.log.log(
            *[
                record(
                    run_id=f"backfill-{month}",
                    dag_id="backfill",
                    task_id=_MONTH_TASK,
                    status=status,
                    started_at=now,
                    finished_at=now,
                    partition_date=month,
                    metadata=metadata(month),
                )
                for month in which
            ]
        )

    def _misfits(self, sources: dict[dt.date, DataFrame]) -> dict[dt.date, str]:
        """Why months could not be loaded, from two passes over all of them together."""
        if not sources:
            return {}
        each = [bronze.screened(s, schemas.RAW_TRIPS.not_null) for s in sources.values()]
        trips = reduce(DataFrame.unionByName, each)
        found = {}
        for row in bronze.outcome(trips).filter("unfit > 0 or missing > 0").collect():
            found[row["partition_date"]] = (
                f"{row['unfit']} rows with values that do not fit,"
                f" {row['missing']} with missing values"
            )
        zones = bronze.conform_zones(files.read_zones(self.spark, self.zones_path))
        sound = trips.filter("not unfit and not missing").drop("unfit", "missing")
        visited = staging.trips(sound).select(
            "partition_date",
            F.explode(F.array("pu_location_id", "do_location_id")).alias("location_id"),
        )
        orphans = visited.distinct().join(zones, "location_id", "left_anti")
        for row in orphans.groupBy("partition_date").count().collect():
            reason = f"{row['count']} zones that do not exist"
            found.setdefault(row["partition_date"], reason)
        return found

    def _bronze(self, paths: dict[dt.date, str]) -> None:
        with self._tracked("bronze", "ingest_trips", list(paths)) as results:
            results.append(self.ingest_trips(paths))
        with self._tracked("bronze", "ingest_zones") as results:
            results.append(self.ingest_zones())
        quality.require(self.validate_zones())

    def _silver_and_gold(self, wanted: list[dt.date]) -> None:
        with self._tracked("silver", "silver_zones") as results:
            results.append(self.build_silver_zones())
        with self._tracked("silver", "silver_trips", wanted) as results:
            results.append(self.build_silver_trips(wanted))
        with self._tracked("silver", "test_silver"):
            self.test_silver()
        with self._tracked("gold", "build_gold") as results:
            results.extend(self.build_gold().values())
        with self._tracked("gold", "test_gold"):
            self.test_gold()
        with self._tracked("gold", "load_fact_trips", wanted) as results:
            silver_rows = in_partitions(self.store.read(schemas.SILVER_TRIPS), wanted)
            lake_rows = gold.published(silver_rows)
            # Silver's files are of one month each, and so can the lake's be.
            results.append(self.store.upsert(schemas.LAKE_TRIPS, lake_rows, together=True))
        with self._tracked("gold", "load_dim_zones") as results:
            results.append(self.publish_zones())

    def _tracked(self, layer: str, task: str, wanted: Sequence[dt.date] = ()):
        month = wanted[0] if len(wanted) == 1 else None
        return self.log.track(layer, task, month, months=[str(m) for m in wanted])

    def _log_failed(self, failed: dict[dt.date, str]) -> None:
        now = dt.datetime.now(dt.timezone.utc)
        records = [
            record(
                run_id=f"backfill-{now:%Y-%m-%dT%H:%M:%S.%f}-{month}",
                dag_id="bronze",
                task_id="validate_trips",
                status=FAILED,
                started_at=now,
                finished_at=now,
                partition_date=month,
                error_message=message,
            )
            for month, message in failed.items()
        ]
        if records:
            self.log.log(*records)


def _require_none(violations: DataFrame, rule: str) -> None:
    """Raise if a check returned rows; they are summed up by Spark."""
    total = violations.agg(F.sum("n")).first()[0]
    if total:
        raise RuleFailed(rule, int(total))
