"""Small tables that sum up the partitions of a large one, kept up partition by partition."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.schemas import Table


class Summary:
    """A stored table made of another table's partitions, each by itself.

    `build` turns rows of the base into rows of the summary, which keep the partition column; it
    must give for several partitions together what it gives for each.  With every partition the stamp
    of the files it was made from is kept: a partition whose files are others now is made
    anew, one that is gone is removed, and nothing else is read.
    """

    def __init__(self, store, base: Table, name: str, schema, build: Callable[[DataFrame], DataFrame]):
        self.store, self.base, self.build = store, base, build
        self.table = Table(f"{base.name}__{name}", schema, partition_by=base.partition_by)
        self._ledger = f"{store.path(self.table)}__stamps"

    def _known(self) -> dict[str, str]:
        return json.loads(self.store.files.read_text(self._ledger) or "{}")

    def stale(self, among: Sequence[object] | None = None) -> list[object]:
        """Base partitions, all or `among` these, that the summary does not hold as they are."""
        known, now = self._known(), self.store.stamps(self.base)
        wanted = None if among is None else set(among)
        return [
            v
            for v, stamp in now.items()
            if (wanted is None or v in wanted) and known.get(str(v)) != stamp
        ]

    def refresh(self, among: Sequence[object] | None = None) -> list[object]:
        """Bring the summary up to date, for all partitions or `among` these; those made anew."""
        known, now = self._known(), self.store.stamps(self.base)
        wanted = None if among is None else set(among)
        stale = [
            v
            for v, stamp in now.items()
            if (wanted is None or v in wanted) and known.get(str(v)) != stamp
        ]
        there = {str(v) for v in now}
        gone = [v for v in self.store.partitions(self.table) if str(v) not in there]
        self.store.ensure(self.table)
        if stale or gone:
            column = F.col(self.base.partition_by)
            made = self.build(self.store.read(self.base, column.isin(stale)))
            made = made.select(
                *[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.table.schema]
            )
            self.store.replace_partitions(self.table, made, [*stale, *gone])
            kept = {k: s for k, s in known.items() if k in there}
            kept |= {str(v): now[v] for v in stale}
            self.store.files.write_text(self._ledger, json.dumps(kept))
        return stale

    def read(self, where: Column | str | None = None) -> DataFrame:
        return self.store.read(self.table, where)
