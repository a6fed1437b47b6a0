"""Checks of what has changed since a table last passed them."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.operators import merge
from tripmart.schemas import Table


class Verified:
    """What a table's checks have last passed on: its partitions' stamps, and values it refers to.

    A partition counts as changed if its files are not those that were checked.
    """

    def __init__(self, store, table: Table):
        self.store, self.table = store, table
        self._ledger = f"{store.path(table)}__verified"

    def _noted(self) -> dict:
        text = self.store.files.read_text(self._ledger)
        return json.loads(text) if text else {"stamps": {}, "parents": {}}

    def changed(self) -> list[object]:
        """Partitions that are new or other than those checked."""
        noted, now = self._noted()["stamps"], self.store.stamps(self.table)
        return [v for v, stamp in now.items() if noted.get(str(v)) != stamp]

    def removed(self, parent: str, present: Sequence[object]) -> list[object]:
        """Values of a small parent table that were there at the last check and are not now."""
        return sorted(set(self._noted()["parents"].get(parent, ())) - set(present))

    def note(self, parents: dict[str, Sequence[object]]) -> None:
        """All checks have passed on the table as it is."""
        now = {str(v): stamp for v, stamp in self.store.stamps(self.table).items()}
        noted = {"stamps": now, "parents": {k: sorted(v) for k, v in parents.items()}}
        self.store.files.write_text(self._ledger, json.dumps(noted))


def repeated_keys(store, table: Table, changed: Sequence[object]) -> DataFrame:
    """Keys of the changed partitions that the whole table holds more than once, with their count.

    Changed rows are compared with each other and with partitions that hold one of their keys, found
    by the key index; if all others had distinct keys before, these are all repeated keys.
    """
    part, keys = F.col(table.partition_by), list(table.keys)
    rows = store.read(table, part.isin(list(changed))).select(*keys)
    elsewhere = store.partitions_holding(table, rows, keys, changed)
    if not elsewhere and merge.none_repeated(rows, keys):
        rows = rows.limit(0)
    if elsewhere:
        others = store.read(table, part.isin(elsewhere)).select(*keys)
        rows = rows.unionByName(others.join(rows, keys, "left_semi"))
    return merge.repeated_keys(rows, keys)
