"""The few errors callers may want to tell apart."""

from __future__ import annotations


class TripmartError(Exception):
    """Base class of everything raised on purpose by this package."""


class SourceMissing(TripmartError):
    """A source path does not exist or has an unsupported format."""


class MissingColumns(TripmartError):
    """A source lacks required columns; `missing` holds all of them, sorted."""

    def __init__(self, table: str, missing: list[str]):
        super().__init__(f"{table}: missing columns {', '.join(missing)}")
        self.table = table
        self.missing = missing


class RuleFailed(TripmartError):
    """A data-quality rule did not hold."""

    def __init__(self, rule: str, failure_count: int):
        super().__init__(f"rule {rule} failed for {failure_count} values")
        self.rule = rule
        self.failure_count = failure_count


class RuleCrashed(TripmartError):
    """A data-quality rule could not be evaluated at all."""


class DuplicateKeys(TripmartError):
    """An upsert source holds the same key more than once."""


class SchemaChanged(TripmartError):
    """An incremental load does not have the columns of its table."""
