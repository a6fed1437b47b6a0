"""Tables as partitioned Parquet folders.

A load is written beside the table and published when all its tasks are done (see
`operators.publishing`): folders of partitions, or the table's folder, take the place of earlier ones.
There is one writer per table at a time; other jobs open the store `read_only`.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import time
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.errors import DuplicateKeys, SchemaChanged
from tripmart.operators import curve, merge, packing, publishing
from tripmart.operators.key_index import KeyIndex
from tripmart.operators.staging_area import staged_meanwhile
from tripmart.schemas import Table


@dataclass(frozen=True)
class LoadResult:
    """What one load did; `partitions` are those holding written rows."""

    table: str
    rows: int
    path: str
    partitions: tuple[object, ...] = ()
    seconds: float = 0.0


class TableStore:
    """Tables below one root folder, which all executors must see.

    What a crashed job left half published is finished when the table is next used, by any but a
    `read_only` store: that one reads beside a writer and changes nothing.
    """

    def __init__(self, spark: SparkSession, root: str, *, read_only: bool = False):
        self.spark = spark
        self.root = root.rstrip("/")
        self.read_only = read_only
        self.files = publishing.Files(spark)

    # Reading

    def path(self, table: Table) -> str:
        return f"{self.root}/{table.name}"

    def exists(self, table: Table) -> bool:
        self.recover(table)
        return self.files.exists(self.path(table))

    def recover(self, table: Table) -> bool:
        """Finish a load that a crash cut off while it was published; whether there was one."""
        return not self.read_only and publishing.recover(self.files, self._intent(table))

    def read(self, table: Table, where: Column | str | None = None) -> DataFrame:
        """Rows of a table; a condition on the partition column prunes folders."""
        self.recover(table)
        df = self._reader(table).parquet(self.path(table))
        return df if where is None else df.filter(where)

    def partitions(self, table: Table) -> list[object]:
        """Values of the partition column, from folder names; a folder always has rows."""
        self.recover(table)
        return sorted(self._folders(table))

    def stamps(self, table: Table) -> dict[object, str]:
        """What tells a partition's present files from all earlier ones: file names are never reused."""
        if not self.exists(table):
            return {}
        listed: dict[str, list[str]] = {}
        for file in self.read(table).inputFiles():
            folder, name = unquote(file).rsplit("/", 2)[1:]
            listed.setdefault(folder, []).append(name)
        return {
            self._value(table, folder): hashlib.sha256("/".join(sorted(names)).encode()).hexdigest()
            for folder, names in sorted(listed.items())
        }

    def key_index(self, table: Table) -> KeyIndex:
        return KeyIndex(self, table)

    # Writing

    def ensure(self, table: Table) -> None:
        """Create an empty table if there is none."""
        if not self.exists(table):
            empty = self.spark.createDataFrame([], table.schema)
            self.overwrite(table, empty)

    def overwrite(
        self,
        table: Table,
        df: DataFrame,
        allow_schema_change: bool = False,
        *,
        together: bool = False,
    ) -> LoadResult:
        """Replace a whole table; the old one stays until the new one is complete.

        Rows are brought together by partition, unless they are `together` as they come; so in the
        other loads.
        """
        started = time.monotonic()
        if not allow_schema_change:
            self._require_schema(table, df)
        rows = df if together else self._rebalanced(df, table)
        seen, observed = self._observed(rows, table)
        stage = self._new_stage(table)
        self._writer(observed, table).parquet(stage)
        self._publish(table, [(stage, self.path(table))])
        return self._result(table, seen.get, started)

    def replace_partitions(
        self, table: Table, df: DataFrame, values: Sequence[object], *, together: bool = False
    ) -> LoadResult:
        """Replace the named partitions by `df`; one without new rows becomes empty."""
        started = time.monotonic()
        self._require_schema(table, df)
        column = F.col(table.partition_by)
        guarded = df.withColumn(
            table.partition_by,
            F.when(column.isin(list(values)), column).otherwise(
                F.raise_error(F.concat(F.lit("row outside the named partitions: "), column))
            ),
        )
        written = self._write_partitions(table, guarded, values, in_order=together)
        return self._result(table, written, started)

    def upsert(
        self,
        table: Table,
        df: DataFrame,
        keys: Sequence[str] | None = None,
        *,
        together: bool = False,
    ) -> LoadResult:
        """Insert `df`, replacing rows with equal keys; only touched partitions are rewritten.

        Of an indexed table, only partitions of which the index says that they may hold a key are
        looked at.  The number of rows reported is that of the source.

        Where there is nothing to merge with, the source is written at once, and published
        if its keys are found unique there.
        """
        started = time.monotonic()
        keys = list(keys or table.keys)
        self._require_schema(table, df)
        if table.partition_by:
            part = F.col(table.partition_by)
            missing = F.raise_error(F.lit(f"{table.name}.{table.partition_by} must not be NULL"))
            df = df.withColumn(
                table.partition_by, F.when(part.isNull(), missing).otherwise(part)
            )
        if table.partition_by and not self.partitions(table):
            written = self._write_partitions(table, df, in_order=together, unique=keys)
            partitions, rows = tuple(sorted(written["partitions"])), written["rows"]
        else:
            # The source is used several times and must be the same each time.
            with staged_meanwhile(df) as source:
                merge.require_unique(source, keys, table.name)
                partitions = self._merge(table, source, keys)
                rows = source.count()
        if table.indexed and partitions:
            self.key_index(table).refresh(partitions)
        seconds = time.monotonic() - started
        return LoadResult(table.name, rows, self.path(table), partitions, seconds)

    def append(self, table: Table, df: DataFrame, instead_of: Sequence[str] = ()) -> None:
        """Add a few rows as one file to an unpartitioned table, whoever else is adding some.

        The file is moved in by one rename, so that it is there or not.  `instead_of` names files
        whose place it takes.
        """
        self._require_schema(table, df)
        if self.read_only:
            raise PermissionError(f"{table.name}: this store is read-only")
        stage = f"{self.path(table)}__append_{uuid.uuid4().hex}"
        df.coalesce(1).write.parquet(stage)
        self.files.make_folder(self.path(table))
        steps: list[publishing.Step] = [
            (f"{stage}/{name}", f"{self.path(table)}/{name}")
            for name in self.files.names(stage)
            if name.startswith("part-")
        ]
        if instead_of:
            gone = [(None, file) for file in instead_of]
            publishing.publish(self.files, self._intent(table), [*steps, *gone], [stage])
        else:
            for source, target in steps:
                self.files.rename(source, target)
            self.files.delete(stage)

    def compact(
        self,
        table: Table,
        values: Sequence[object] | None = None,
        *,
        small_bytes: int = packing.SMALL,
        target_bytes: int = packing.TARGET,
    ) -> LoadResult:
        """Put small files of the named partitions, or of all, together; others stay as they are.

        Files under `small_bytes` are packed into groups of up to `target_bytes`; each group
        becomes one file.  A single small file of a partition is left alone.  The rows
        reported are those moved.
        """
        started = time.monotonic()
        self.recover(table)
        sizes = packing.file_sizes(self.spark, self.path(table))
        wanted = None if values is None else set(values)
        chosen = [
            (folder, file, size)
            for folder, file, size in sizes
            if size < small_bytes and (wanted is None or self._value(table, folder) in wanted)
        ]
        groups = packing.packed(chosen, target_bytes)
        if not groups:
            return LoadResult(table.name, 0, self.path(table), (), time.monotonic() - started)
        number = {file: n for n, group in enumerate(groups) for _, file in group}
        small = (
            self.spark.read.schema(table.schema)
            .option("basePath", self.path(table))
            .parquet(*number)
        )
        # One row per small file.
        named = self.spark.createDataFrame(list(number.items()), "_file string, _group int")
        grouped = small.withColumn("_file", F.col("_metadata.file_path")).join(
            F.broadcast(named), "_file"
        )
        stage, seen = self._new_stage(table), Observation()
        part = table.partition_by
        metrics = (F.count(F.lit(1)).alias("rows"), F.collect_set(part).alias("partitions"))
        (
            grouped.drop("_file")
            .observe(seen, *metrics)
            .repartition(len(groups), "_group")
            .write.partitionBy(part, "_group")
            .parquet(stage)
        )
        steps = []
        for folder in self._partition_names(stage, part):
            for group in self._partition_names(f"{stage}/{folder}", "_group"):
                source = f"{stage}/{folder}/{group}"
                steps += [
                    (f"{source}/{name}", f"{self.path(table)}/{folder}/{name}")
                    for name in self.files.names(source)
                    if name.startswith("part-")
                ]
        steps += [(None, file) for file in number]
        self._publish(table, steps, [stage])
        return self._result(table, seen.get, started)

    def cluster(
        self,
        table: Table,
        columns: Sequence[str],
        values: Sequence[object],
        *,
        file_bytes: int = packing.TARGET,
        rows_per_group: int | None = None,
    ) -> LoadResult:
        """Lay the named partitions out along a curve through `columns` (see `operators.curve`).

        Filters on any of the columns then find most row groups out of range.
        """
        started = time.monotonic()
        part = F.col(table.partition_by)
        named = {self._folders(table).get(v) for v in values}
        sizes = packing.file_sizes(self.spark, self.path(table))
        held = sum(size for folder, _, size in sizes if folder in named)
        parts = max(1, -(-held // file_bytes), len(values))
        stored = self.read(table, part.isin(list(values)))
        ordered = curve.along_curve(stored, columns, parts, [table.partition_by])
        options = {"parquet.block.row.count.limit": rows_per_group} if rows_per_group else {}
        written = self._write_partitions(table, ordered, values, in_order=True, **options)
        return self._result(table, written, started)

    # Helpers

    def _merge(self, table: Table, source: DataFrame, keys: list[str]) -> tuple[object, ...]:
        """Publish the merged table; the partitions holding rewritten rows."""
        if table.partition_by is None:
            new = not self.exists(table)
            merged = source if new else merge.upserted(self.read(table), source, keys)
            self.overwrite(table, merged)
            return ()
        touched = self._touched_partitions(table, source, keys)
        target = self.read(table, F.col(table.partition_by).isin(touched))
        written = self._write_partitions(table, merge.upserted(target, source, keys), touched)
        return tuple(sorted(written["partitions"]))

    def _reader(self, table: Table):
        return self.spark.read if table.schema is None else self.spark.read.schema(table.schema)

    def _require_schema(self, table: Table, df: DataFrame) -> None:
        if table.schema is None:
            return
        want = {f.name: f.dataType for f in table.schema}
        got = {f.name: f.dataType for f in df.schema}
        if want != got:
            differing = sorted(
                c for c in want.keys() | got.keys() if want.get(c) != got.get(c)
            )
            raise SchemaChanged(f"{table.name}: columns differ: {', '.join(differing)}")

    def _touched_partitions(
        self, table: Table, source: DataFrame, keys: Sequence[str]
    ) -> list[object]:
        """Partitions of the source, and those its keys now lie in; one value each."""
        part = table.partition_by
        own = [r[0] for r in source.select(part).distinct().collect()]
        return own + self.partitions_holding(table, source, keys, set(own))

    def partitions_holding(
        self, table: Table, source: DataFrame, keys: Sequence[str], leave_out: Iterable[object] = ()
    ) -> list[object]:
        """Partitions with a key of `source`, without those to leave out.

        Keys are read of partitions that may hold one: all of them, unless the index knows better.
        """
        part = table.partition_by
        possible = sorted(set(self.partitions(table)) - set(leave_out))
        if table.indexed and list(keys) == list(table.keys):
            index = self.key_index(table)
            index.refresh(possible)
            possible = index.partitions_that_may_hold(source, possible)
        if not possible:
            return []
        found = (
            self.read(table, F.col(part).isin(possible))
            .select(*keys, part)
            .join(source.select(*keys), list(keys), "left_semi")
            .select(part)
            .distinct()
        )
        return [r[0] for r in found.collect()]

    def _rebalanced(self, df: DataFrame, table: Table) -> DataFrame:
        """Rows of one partition brought together, large partitions cut into even files."""
        return df.hint("rebalance", table.partition_by) if table.partition_by else df

    def _observed(self, df: DataFrame, table: Table) -> tuple[Observation, DataFrame]:
        """`df` that reports its row count and partitions while being written."""
        seen = Observation()
        part = F.col(table.partition_by) if table.partition_by else F.lit(None).cast("string")
        metrics = (
            F.count(F.lit(1)).alias("rows"),
            F.collect_set(part).alias("partitions"),
        )
        return seen, df.observe(seen, *metrics)

    def _writer(self, df: DataFrame, table: Table):
        # Ids are hashes in hex, which this packs to half of what the default does.
        writer = df.write.mode("overwrite").option("compression", "zstd")
        if table.partition_by:
            writer = writer.option("partitionOverwriteMode", "dynamic")
            writer = writer.partitionBy(table.partition_by)
        return writer

    def _write_partitions(
        self,
        table: Table,
        df: DataFrame,
        replaced: Iterable[object] = (),
        in_order: bool = False,
        unique: Sequence[str] = (),
        **options,
    ) -> dict:
        """Publish `df` in place of the partitions it has rows of; others `replaced` go.

        Rows are brought together by partition, unless they are to be written in their order.
        Nothing is published if values of `unique` are found more than once in what was written.
        """
        rows = df if in_order else self._rebalanced(df, table)
        seen, observed = self._observed(rows, table)
        stage, target = self._new_stage(table), self.path(table)
        self._writer(observed, table).options(**options).parquet(stage)
        if unique and seen.get["rows"]:
            try:
                merge.require_unique(self._reader(table).parquet(stage), unique, table.name)
            except DuplicateKeys:
                self.files.delete(stage)
                raise
        steps: list[publishing.Step] = [
            (f"{stage}/{name}", f"{target}/{name}")
            for name in self._partition_names(stage, table.partition_by)
        ]
        self.files.make_folder(target)
        emptied = set(replaced) - set(seen.get["partitions"])
        folders = self._folders(table)
        steps += [(None, f"{target}/{folders[v]}") for v in emptied if v in folders]
        self._publish(table, steps, [stage])
        return seen.get

    def _new_stage(self, table: Table) -> str:
        """Where a load is written first; what loads cut off earlier have left is removed."""
        self.recover(table)
        above, name = self.path(table).rsplit("/", 1)
        for left in self.files.names(above):
            if left.startswith(f"{name}__stage_"):
                self.files.delete(f"{above}/{left}")
        return f"{above}/{name}__stage_{uuid.uuid4().hex}"

    def _publish(
        self, table: Table, steps: Sequence[publishing.Step], leftovers: Sequence[str] = ()
    ) -> None:
        if self.read_only:
            raise PermissionError(f"{table.name}: this store is read-only")
        publishing.publish(self.files, self._intent(table), steps, leftovers)

    def _intent(self, table: Table) -> str:
        return f"{self.path(table)}__intent"

    def _result(self, table: Table, written: dict, started: float) -> LoadResult:
        return LoadResult(
            table.name,
            written["rows"],
            self.path(table),
            tuple(sorted(written["partitions"])),
            time.monotonic() - started,
        )

    def _partition_names(self, folder: str, column: str) -> list[str]:
        return [n for n in self.files.names(folder) if n.startswith(f"{column}=")]

    def _folders(self, table: Table) -> dict[object, str]:
        """Folder name of each partition."""
        names = self._partition_names(self.path(table), table.partition_by)
        return {self._value(table, name): name for name in names}

    def _value(self, table: Table, folder: str) -> object:
        """The value of the partition column that a folder's name stands for."""
        text = unquote(folder.removeprefix(f"{table.partition_by}="))
        is_date = table.schema[table.partition_by].dataType == T.DateType()
        return dt.date.fromisoformat(text) if is_date else text
