"""The run log: records of loads, appended by any number of writers and folded when read.

Each record is an event in a file of its own.  A run's columns come from its first event, those that later
records may change from its last one.
"""

from __future__ import annotations

import datetime as dt
import itertools
import json
import time
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.errors import DuplicateKeys
from tripmart.schemas import RUN_EVENTS, RUN_LOG
from tripmart.store import LoadResult, TableStore

# What a later record of the same run may change.
UPDATED_COLUMNS = (
    "status",
    "rows_written",
    "duration_seconds",
    "error_message",
    "finished_at",
    "metadata",
)


# States of a load.
RUNNING, SUCCESS, FAILED = "running", "success", "failed"


def record(**values) -> tuple:
    """A row of the run log from named values; what is not given is NULL."""
    names = RUN_LOG.schema.names
    if unknown := values.keys() - set(names):
        raise TypeError(f"the run log has no {', '.join(sorted(unknown))}")
    seconds = values.get("duration_seconds")
    if seconds is not None:
        values["duration_seconds"] = round(Decimal(str(seconds)), 3)
    values["metadata"] = json.dumps(values.get("metadata") or {})
    return tuple(values.get(name) for name in names)


def folded(events: DataFrame, update: Sequence[str] = UPDATED_COLUMNS) -> DataFrame:
    """One event per run: `update` columns, even if NULL, as last logged, all others as first.

    Folding folded events again, with others, gives what folding all of them at once gives.
    """
    kept = [c for c in RUN_LOG.schema.names if c not in (*RUN_LOG.keys, *update)]
    return events.groupBy(*RUN_LOG.keys).agg(
        *[F.min_by(c, "opened").alias(c) for c in kept],
        *[F.max_by(c, "logged").alias(c) for c in update],
        F.min("opened").alias("opened"),
        F.max("logged").alias("logged"),
    )


def latest(log: DataFrame, n: int, group: str = "dag_id") -> DataFrame:
    """The `n` newest runs per group, newest first by start time."""
    newest = Window.partitionBy(group).orderBy(F.desc("started_at"), "run_id", "task_id")
    return log.withColumn("nth", F.row_number().over(newest)).filter(F.col("nth") <= n)


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


class RunLog:
    def __init__(self, store: TableStore):
        self.store = store
        self._writer = uuid.uuid4().hex
        self._number = itertools.count()

    def read(self) -> DataFrame:
        if not self.store.exists(RUN_EVENTS):
            return self.store.spark.createDataFrame([], RUN_LOG.schema)
        return folded(self.store.read(RUN_EVENTS)).select(*RUN_LOG.schema.names)

    def log(self, *records: tuple) -> None:
        """Add or update records (see `record`); each run may occur once per call."""
        at = [RUN_LOG.schema.names.index(key) for key in RUN_LOG.keys]
        if len({tuple(r[i] for i in at) for r in records}) < len(records):
            raise DuplicateKeys(f"{RUN_LOG.name}: a run occurs twice")
        when = (time.time_ns(), self._writer, next(self._number))
        events = [(*r, when, when) for r in records]
        self.store.append(RUN_EVENTS, self.store.spark.createDataFrame(events, RUN_EVENTS.schema))

    def settle(self) -> int:
        """Fold the files of events there are now into one; how many there were.

        Events that others append meanwhile stay as they are.
        """
        if not self.store.exists(RUN_EVENTS):
            return 0
        there = self.store.read(RUN_EVENTS).inputFiles()
        if len(there) > 1:
            names = RUN_EVENTS.schema.names
            events = self.store.spark.read.schema(RUN_EVENTS.schema).parquet(*there)
            self.store.append(RUN_EVENTS, folded(events).select(*names), instead_of=there)
        return len(there)

    def latest(self, n: int) -> DataFrame:
        return latest(self.read(), n)

    @contextmanager
    def track(
        self,
        dag_id: str,
        task_id: str,
        month: dt.date | None = None,
        run_id: str | None = None,
        **metadata,
    ) -> Iterator[list[LoadResult]]:
        """Log a load as running, then as a success or failure.

        The body appends its results to the list it is given; an error is logged
        and raised again.
        """
        started = _now()
        run_id = run_id or f"{started:%Y-%m-%dT%H:%M:%S}-{uuid.uuid4().hex[:8]}"
        base = dict(
            run_id=run_id,
            dag_id=dag_id,
            task_id=task_id,
            started_at=started,
            partition_date=month,
            metadata=metadata,
        )
        self.log(record(status=RUNNING, **base))
        results: list[LoadResult] = []

        def finished(status: str, error: str | None = None) -> tuple:
            end = _now()
            return record(
                status=status,
                finished_at=end,
                duration_seconds=(end - started).total_seconds(),
                rows_written=sum(r.rows for r in results),
                delta_path=results[-1].path if results else None,
                error_message=error,
                **base,
            )

        try:
            yield results
        except Exception as error:
            self.log(finished(FAILED, str(error)))
            raise
        self.log(finished(SUCCESS))
