"""Resharding documents by minimum-cost flow: near-equal bytes, fewest bytes moved."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.flow import transfers
from llm.lines import small
from llm.scratch import Scratch

# Bytes that a document takes besides its text.
HEADER = 16
# Rows of one block: what one task orders at once.
BLOCK_ROWS = 50_000
ADDED = ("size", "old_shard", "shard", "slot")


def stored_size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + HEADER).cast("bigint")


def size_class(size: Column) -> Column:
    """Sizes fall along a shard, in classes by powers of two."""
    return -F.floor(F.log2(size)).cast("int")


def block(row: Column) -> Column:
    return F.floor(row / BLOCK_ROWS).cast("bigint")


def placed(
    docs: DataFrame, old_shard: Column, scratch: Scratch, *, keep_text: bool = True
) -> DataFrame:
    """`docs` with size, old_shard and block, written once; without text on request.

    A block is a stretch of at most BLOCK_ROWS rows of one task's output and one old shard.  Blocks
    come from row positions, so that no key, however frequent, makes a large one.
    """
    row = F.monotonically_increasing_id()
    sized = docs.drop(*ADDED).withColumns(
        {"size": stored_size(F.col("text")), "old_shard": old_shard.cast("int"), "_row": row}
    )
    written = scratch.write(sized if keep_text else sized.drop("text"))
    return written.withColumn("_block", block(F.col("_row")))


def write_shards(docs: DataFrame, old_shard: Column, folder: str) -> DataFrame:
    """`docs` written as folders `old_shard=N` and read back, with text and row numbers.

    A task writes its rows by shard and size class, in their order, and numbers them as they lie
    there.  So the rows of one task, shard and class have consecutive numbers.
    """
    own = docs.drop(*ADDED)
    row = F.monotonically_increasing_id()
    size = size_class(stored_size(F.col("text")))
    placed_ = (
        own.withColumns({"old_shard": old_shard.cast("int"), "_class": size, "_row": row})
        .sortWithinPartitions("old_shard", "_class", "_row")
        .drop("_class")
        .withColumn("_row", row)
    )
    placed_.write.partitionBy("old_shard").option("compression", "zstd").parquet(folder)
    return docs.sparkSession.read.schema(placed_.schema).parquet(folder)


def sized(stored: DataFrame) -> DataFrame:
    """Rows of stored shards with size and block, without text."""
    return stored.withColumns(
        {"size": stored_size(F.col("text")), "_block": block(F.col("_row"))}
    ).drop("text")


def rewritten(stored: DataFrame, rows: DataFrame, folder: str, scratch: Scratch) -> DataFrame:
    """Shards as they are stored after a move: text, shard, slot, size and old_shard.

    `stored` are the old shards, `rows` what `reshard` says of them, by _row.  Affected shards
    are written to `folder` with their texts and read from there; others keep their old
    files.  The texts stay in the tasks that read them, see `located`.
    """
    moved = scratch.write(
        rows.select("_row", "old_shard", "shard", "slot", "size", "_block", "_class")
    )
    touched = affected(moved)
    found = located(stored, moved, scratch)
    write_affected(found, folder, touched=touched)
    spark = rows.sparkSession
    plain = stored.drop("_row").columns
    columns = [*[c for c in plain if c != "old_shard"], "old_shard", "shard", "slot"]
    kept = found.filter(~F.col("old_shard").isin(touched)).select(*columns)
    if touched:
        kinds = stored.drop("_row").withColumns(
            {"shard": F.lit(0), "slot": F.lit(0).cast("bigint")}
        )
        fresh = spark.read.schema(kinds.schema).parquet(folder)
        kept = kept.unionByName(fresh.select(*columns))
    return kept.withColumn("size", stored_size(F.col("text")))


def located(stored: DataFrame, moved: DataFrame, scratch: Scratch) -> DataFrame:
    """`stored` with shard and slot, block and class, without a shuffle of its texts.

    Rows of one old shard, class and block mostly go to one shard, with slots in the order of their
    numbers; if these are consecutive, as `write_shards` makes them, a row's number tells its slot.
    Such groups are one row each and sent to the texts.  Only groups that are divided, at most
    one for each cut, are joined row by row.
    """
    key = ["old_shard", "_class", "_block"]
    groups = moved.groupBy(*key).agg(
        F.min("_row").alias("_first"),
        (F.max("_row") - F.min("_row") + 1 == F.count(F.lit(1))).alias("_dense"),
        F.min("shard").alias("shard"),
        F.max("shard").alias("_other"),
        F.min("slot").alias("_slot"),
    )
    groups = scratch.write(
        groups.withColumn("_whole", F.col("_dense") & (F.col("shard") == F.col("_other")))
    )
    whole = scratch.write(groups.filter("_whole").select(*key, "_first", "shard", "_slot"))
    divided = scratch.write(groups.filter("not _whole").select(*key))
    single = scratch.write(
        moved.join(small(divided), key, "left_semi").select("_row", "shard", "slot")
    )
    rows = stored.withColumns(
        {"_class": size_class(stored_size(F.col("text"))), "_block": block(F.col("_row"))}
    )
    columns = [*rows.columns, "shard", "slot"]
    slot = F.col("_slot") + F.col("_row") - F.col("_first")
    together = rows.join(small(whole), key).withColumn("slot", slot)
    apart = rows.join(small(divided), key, "left_semi").join(single, "_row")
    return together.select(*columns).unionByName(apart.select(*columns))


def capacities(total: int, shards: int) -> list[int]:
    """Near-equal parts of `total`."""
    return [total // shards + (k < total % shards) for k in range(shards)]


def reshard(
    rows: DataFrame,
    old: int,
    new: int,
    scratch: Scratch,
    *,
    cost: Callable[[int, int], int] = lambda i, j: int(i != j),
) -> DataFrame:
    """`rows` of `placed` with shard and slot.

    The sizes of the `old` shards and equal capacities of the `new` ones make a flow problem;
    its solution says how many bytes of each old shard go to which new one, so that the fewest bytes
    change their shard (`cost` may weigh moves otherwise).  Each old shard's blocks are laid
    end to end, what stays first, and cut at these amounts: whole blocks go by their place,
    and only blocks that a cut falls into are divided, row by row.  A row goes where its middle falls,
    and small rows lie at the cuts, so that shards differ from their capacity by about a
    small document.

    slot counts a shard's rows from 0 without gaps.  Rows of any null, repeat or size are
    placed like others.  Tables sent to the driver have a row per old shard; the cuts, one
    row per pair of shards that exchanges bytes, are all that is broadcast.
    """
    # The cuts, which lie at the end of what stays, fall among small rows.
    rows = rows.withColumn("_class", size_class(F.col("size")))
    blocks = rows.groupBy("old_shard", "_class", "_block").agg(F.sum("size").alias("bytes"))
    blocks = scratch.write(blocks)
    held = [0] * old
    for r in blocks.groupBy("old_shard").agg(F.sum("bytes").alias("b")).collect():
        held[r["old_shard"]] = r["b"]
    flow = transfers(held, capacities(sum(held), new), cost)
    cuts = []
    for i in range(old):
        at = 0
        for j in sorted((j for k, j in flow if k == i), key=lambda j: (cost(i, j), j)):
            cuts.append((i, at, at + flow[i, j], j))
            at += flow[i, j]
    spark = rows.sparkSession
    plan = F.broadcast(
        spark.createDataFrame(cuts, "old_shard int, first bigint, until bigint, shard int")
    )
    # Offsets of blocks: over block totals of one shard, and within a block over its rows.
    order = Window.partitionBy("old_shard").orderBy("_class", "_block")
    starts = scratch.write(
        blocks.withColumn("_start", F.sum("bytes").over(order) - F.col("bytes")).drop("bytes")
    )
    key = ["old_shard", "_class", "_block"]
    inside = Window.partitionBy(*key).orderBy(F.desc("size"), "_row")
    located = (
        rows.join(starts, key)
        .withColumn("_at", F.col("_start") + F.sum("size").over(inside) - F.col("size"))
        .withColumn("_middle", F.col("_at") + F.floor(F.col("size") / 2))
    )
    p, r = plan.alias("p"), located.alias("r")
    sent = r.join(
        p,
        (F.col("r.old_shard") == F.col("p.old_shard"))
        & (F.col("r._middle") >= F.col("p.first"))
        & (F.col("r._middle") < F.col("p.until")),
    ).select("r.*", "p.shard")
    return with_slots(scratch.write(sent.drop("_start", "_at", "_middle")), scratch)


def with_slots(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """`rows` with slot: gapless from 0 within shard, by old shard, block and row."""
    key = ["shard", "old_shard", "_class", "_block"]
    counts = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy(*key[1:])
    starts = scratch.write(
        counts.withColumn("_first", F.sum("n").over(before) - F.col("n")).drop("n")
    )
    inside = Window.partitionBy(*key).orderBy("_row")
    return (
        rows.join(starts, key)
        .withColumn("slot", (F.col("_first") + F.row_number().over(inside) - 1).cast("bigint"))
        .drop("_first")
    )


def moves(rows: DataFrame) -> DataFrame:
    """(old_shard, shard, rows, bytes) of what changes its shard."""
    return (
        rows.filter("old_shard <> shard")
        .groupBy("old_shard", "shard")
        .agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes"))
    )


def affected(rows: DataFrame) -> list[int]:
    """Shards that gain or lose rows."""
    changed = moves(rows).select(F.explode(F.array("old_shard", "shard")).alias("shard")).distinct()
    return sorted(r["shard"] for r in changed.collect())


def write_affected(
    rows: DataFrame,
    folder: str,
    rows_per_file: int = 1_000_000,
    *,
    touched: list[int] | None = None,
) -> list[int]:
    """Rewrite the shards that gain or lose rows, as folders `shard=N`; returns these.

    Shards without any move keep their files.  Rows of a shard are spread over tasks by block, and
    slots, not files, hold their order.
    """
    if touched is None:
        touched = affected(rows)
    out = rows.filter(F.col("shard").isin(touched)).drop("_block", "_class", "_row")
    (
        out.write.partitionBy("shard")
        .option("compression", "zstd")
        .option("maxRecordsPerFile", rows_per_file)
        .option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .parquet(folder)
    )
    return touched
