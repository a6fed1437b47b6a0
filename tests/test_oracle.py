"""Every registered query against its SQL in another engine, at the smallest scale."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_points
from tripmart.catalog.oracle import statements
from tripmart.catalog.flows import REGISTERED

from tests.compare import connect, differences

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(REGISTERED) == set(statements())
    assert set(REGISTERED) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(REGISTERED))
def test_same_rows(spark, con, name):
    df = entry_points.queries()[name](spark, FOLDER)
    assert differences(df, con, entry_points.oracle_sql()[name]) == []


def test_entry_runs(spark):
    assert entry_points.entry(spark).count() > 0
