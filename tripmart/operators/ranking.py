"""Row numbers over groups of any size."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.operators.lookup import small
from tripmart.operators.staging_area import staged

# A group of about this many rows is numbered piecewise instead of by one task.
HOT_ROWS = 1_000_000
# Most groups that a summary of frequent ones may track, and how many it tracks for each group that
# could be hot: its counts are off by no more than about a quarter of `hot_rows` then.
MOST_TRACKED, TRACKED_PER_HOT = 1_000_000, 16
# Copies restored from one counted row within one task.
COPIES_PER_TASK = 1_000_000


def numbered(
    df: DataFrame,
    partition_by: Sequence[str],
    order_by: Sequence[str],
    name: str = "row_num",
    *,
    cluster_by: Sequence[str] = (),
    in_ranges: bool = False,
    rows_at_most: int | None = None,
    stored: bool = False,
    hot_rows: int = HOT_ROWS,
    copies_per_task: int = COPIES_PER_TASK,
) -> DataFrame:
    """`df` with `row_number()` over `partition_by` in the order of `order_by`.

    The order is completed with all remaining columns, so only exact copies tie
    and the numbers are reproducible.  One window shuffle serves ordinary groups.
    Groups with `hot_rows` rows or more are found by a summary and numbered across many tasks;
    for that, `df` is evaluated once and written, unless it is `stored`: then it is read from files
    and reading them again is cheaper.  Neither is done if `rows_at_most`, a bound on the rows of
    `df` known to the caller, rules such groups out.

    `cluster_by`, some of the `partition_by` columns, is what the shuffle goes by,
    so that later steps grouping by these and other columns need none of their own.  `in_ranges`
    of them, rows near to each other in their order come out of one task, to be written as they lie.
    """
    rest = [c for c in df.columns if c not in (*partition_by, *order_by)]
    order = [*order_by, *rest]
    may_be_hot = rows_at_most is None or rows_at_most >= hot_rows
    probed_by = cluster_by or partition_by
    hot = None
    if may_be_hot:
        df = df if stored else staged(df)
        hot = staged(_hot_groups(df, probed_by, hot_rows, rows_at_most))
    any_hot = hot is not None and bool(hot.limit(1).count())
    ordinary, in_hot = df, None
    if any_hot:
        # Any number of groups may be hot: they are looked up, not listed.
        marked = df.withColumn("_group", _group_hash(probed_by))
        groups = small(hot.withColumnRenamed("group", "_group"))
        ordinary = marked.join(groups, "_group", "left_anti").drop("_group")
        in_hot = marked.join(groups, "_group", "left_semi").drop("_group")
    if in_ranges:
        ordinary = ordinary.repartitionByRange(*(cluster_by or partition_by))
    elif cluster_by:
        ordinary = ordinary.repartition(*cluster_by)
    by_window = ordinary.withColumn(
        name, F.row_number().over(Window.partitionBy(*partition_by).orderBy(*order)).cast("bigint")
    )
    if in_hot is None:
        return by_window
    piecewise = _numbered_piecewise(in_hot, partition_by, order, name, copies_per_task)
    return by_window.unionByName(piecewise.select(*by_window.columns))


def _group_hash(columns: Sequence[str]) -> Column:
    return F.xxhash64(*columns)


def _hot_groups(
    df: DataFrame, columns: Sequence[str], hot_rows: int, rows_at_most: int | None = None
) -> DataFrame:
    """(group): hashes of all groups that hold `hot_rows` rows, and maybe of some that hold fewer.

    Tasks sum up their rows in summaries of frequent items, which are merged.  A group's count
    in it is never too small, and groups that it drops are smaller than its error.  Where that
    would need a summary too large, groups are counted one by one.
    """
    groups = df.select(_group_hash(columns).alias("group"))
    rows = df.count() if rows_at_most is None else rows_at_most
    tracked = max(64, TRACKED_PER_HOT * math.ceil(rows / hot_rows))
    if tracked > MOST_TRACKED:
        sizes = groups.groupBy("group").count()
        return sizes.filter(F.col("count") >= hot_rows).select("group")
    top = groups.agg(F.expr(f"approx_top_k(`group`, {tracked}, {tracked})").alias("top"))
    found = top.select(F.explode("top").alias("found"))
    return found.filter(F.col("found.count") >= hot_rows).select(F.col("found.item").alias("group"))


def _numbered_piecewise(
    hot: DataFrame,
    partition_by: Sequence[str],
    order: Sequence[str],
    name: str,
    copies_per_task: int,
) -> DataFrame:
    """Number few, huge groups: count copies, cut into ordered slices, add offsets."""
    columns = hot.columns
    group = list(partition_by)
    # Exact copies collapse before the shuffle, and distinct rows of one group can
    # be cut by range.  The slices are written out, because range bounds are drawn
    # anew whenever a plan runs again.
    slices = staged(
        hot.groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("_copies"))
        .repartitionByRange(*group, *order)
        .withColumn("_slice", F.spark_partition_id())
    )
    within = Window.partitionBy("_slice", *group).orderBy(*order)
    local = slices.withColumn(
        "_before",
        F.coalesce(
            F.sum("_copies").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ),
    )
    # Slices are contiguous, so only the first group of a slice can have begun in
    # an earlier one: there is at most one offset per slice.
    earlier = (
        Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = staged(
        slices.groupBy("_slice", *group)
        .agg(F.sum("_copies").alias("_rows"))
        .withColumn("_offset", F.sum("_rows").over(earlier))
        .filter(F.col("_offset") > 0)
        .drop("_rows")
    )
    o, s = offsets.alias("o"), local.alias("s")
    same = F.col("s._slice") == F.col("o._slice")
    for column in group:
        same = same & F.col(f"s.{column}").eqNullSafe(F.col(f"o.{column}"))
    placed = s.join(small(o), same, "left").select(
        *[F.col(f"s.{c}") for c in columns],
        F.col("s._copies"),
        (F.col("s._before") + F.coalesce(F.col("o._offset"), F.lit(0))).alias("_start"),
    )
    # Copies come back in two steps, so that one counted row standing for a huge
    # number of them is restored by many tasks.
    blocks = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_copies") - 1) / copies_per_task))
    spread = placed.withColumn("_block", F.explode(blocks)).repartition(*group, "_start", "_block")
    first = F.col("_block") * copies_per_task
    last = F.least(F.col("_copies"), first + copies_per_task)
    return (
        spread.withColumn("_copy", F.explode(F.sequence(first + 1, last)))
        .withColumn(name, (F.col("_start") + F.col("_copy")).cast("bigint"))
        .drop("_copies", "_start", "_block", "_copy")
    )
