"""Links between similar nodes from banded buckets, without all pairs of a bucket."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.components import components
from llm.scratch import Scratch

# Pairs (a, b) in, the same pairs with their exact similarity (0 to 1) out.
Verify = Callable[[DataFrame], DataFrame]
# Pairs (a, b) in; the same with size_a, `lost` (what b lacks of a) and `gained` (what it has
# beyond a) as arrays out.
Differ = Callable[[DataFrame], DataFrame]
# Aliases of two rows in, whether they can be similar at all out, told by their further columns.
Alike = Callable[[str, str], Column]
# Nodes of a bucket whose pairs are all told by `Alike`; larger buckets take the way of `linked`.
MATES = 8192
# Pairs that are compared for each node of a bucket, and for its hub without a link; buckets with
# more take the way of `linked`.
PAIRS = 16
# Nodes outside the largest component around a hub that are compared with all others.
FEW = 8


def bucket_members(bands: DataFrame, *, preaggregate: bool = True) -> DataFrame:
    """(bucket, hub, node): all nodes of buckets that hold two different nodes or more.

    The hub is a bucket's smallest node; further columns of `bands` stay.  With `preaggregate`, minima are combined
    before the shuffle and the join is one that adaptive execution can split.  Without
    it, `bands` is dealt once by bucket and read twice, half the shuffle for narrow rows.
    """
    if not preaggregate:
        bands = bands.repartition("bucket")
    shared = (
        bands.groupBy("bucket")
        .agg(F.min("node").alias("hub"), F.max("node").alias("last"))
        .filter("hub <> last")
        .drop("last")
    )
    rest = [c for c in bands.columns if c not in ("bucket", "node")]
    return bands.join(shared.hint("shuffle_hash"), "bucket").select("bucket", "hub", "node", *rest)


def with_mates(members: DataFrame, alike: Alike) -> DataFrame:
    """`members` that are alike to another node of their bucket, and `many`; all of many ones.

    Buckets of more than MATES nodes stay whole and have `many` set.  A hub is the smallest
    node that is left of its bucket.
    """
    sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    large = sizes.filter(F.col("n") > MATES).select("bucket")
    # Both sides have the same columns, so that they are shuffled once.
    own = members.drop("hub")
    x = own.join(large, "bucket", "left_anti").alias("x")
    y = own.alias("y").hint("shuffle_hash")
    mates = (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.node") != F.col("y.node"))
    found = x.join(y, mates & alike("x", "y"), "left_semi")
    # By a window: a join would find the mates a second time.
    hub = F.min("node").over(Window.partitionBy("bucket"))
    whole = members.join(large, "bucket", "left_semi").withColumn("many", F.lit(True))
    return found.withColumns({"hub": hub, "many": F.lit(False)}).unionByName(whole)


def linked_alike(
    members: DataFrame,
    alike: Alike,
    verify: Verify,
    differ: Differ,
    threshold: float,
    scratch: Scratch,
) -> DataFrame:
    """(node, component) as `linked` gives it, where most nodes of a bucket have nothing in common.

    `members` is a written table of `with_mates`.  Nodes are verified with their bucket's hub and
    then with all others of another component, if `alike` lets them.  Buckets whose hub has more than
    PAIRS such pairs, or all nodes have on average, and those of too many nodes go through
    `linked` as they are.  A large group of variants holds its bucket's hub, as a rule, and
    so is told by the hub's pairs before its own are made.
    """
    own = members.filter("not many")
    x, y = own.filter("node = hub").alias("x"), own.filter("node <> hub").alias("y")
    stars = x.join(y, (F.col("x.bucket") == F.col("y.bucket")) & alike("x", "y"))
    stars = stars.select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
    checked = scratch.write(verify(stars.distinct()))
    links = checked.filter(F.col("similarity") >= threshold).select("a", "b")
    first = components(links, scratch)
    placed = scratch.write(
        own.join(first, "node", "left").withColumn(
            "component", F.coalesce("component", "node")
        )
    )
    same = (F.col("x.bucket") == F.col("y.bucket")) & (
        F.col("x.component") != F.col("y.component")
    )
    x, y = placed.filter("node = hub").alias("x"), placed.filter("node <> hub").alias("y")
    variants = scratch.write(
        x.join(y, same & alike("x", "y"))
        .groupBy("x.bucket")
        .agg(F.count(F.lit(1)).alias("pairs"))
        .filter(F.col("pairs") > PAIRS)
        .select("bucket")
    )
    open_ = placed.join(variants, "bucket", "left_anti")
    x, y = open_.alias("x"), open_.alias("y")
    apart = same & (F.col("x.node") < F.col("y.node"))
    near = x.join(y.hint("shuffle_hash"), apart & alike("x", "y")).select(
        F.col("x.bucket").alias("bucket"), F.col("x.node").alias("a"), F.col("y.node").alias("b")
    )
    sizes = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("nodes"))
    crowded = scratch.write(
        near.groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("pairs"))
        .join(sizes, "bucket")
        .filter(F.col("pairs") > F.col("nodes") * PAIRS)
        .select("bucket")
    )
    rest = (
        near.join(crowded, "bucket", "left_anti")
        .select("a", "b")
        .distinct()
        .join(checked.select("a", "b"), ["a", "b"], "left_anti")
    )
    more = scratch.write(verify(rest)).filter(F.col("similarity") >= threshold).select("a", "b")
    links = links.unionByName(more)
    large = scratch.write(
        members.filter("many")
        .unionByName(own.join(crowded.unionByName(variants), "bucket", "left_semi"))
        .select("bucket", "hub", "node")
    )
    if large.limit(1).count():
        found = linked(large, verify, differ, threshold, scratch)
        links = links.unionByName(
            found.select(F.col("node").alias("a"), F.col("component").alias("b"))
        )
    elif not more.limit(1).count():
        return first
    return components(links, scratch)


def linked(
    members: DataFrame, verify: Verify, differ: Differ, threshold: float, scratch: Scratch
) -> DataFrame:
    """(node, component) over links of at least `threshold` between nodes of one bucket.

    `members` is a written table as `bucket_members` gives it; similarities are Jaccard's.
    The components are those that verifying all pairs of every bucket would give:

    1. Star edges: every node with its bucket's hub, each pair once.
    2. Components of the verified ones.  Pairs within a component need no look.
    3. Around a hub whose nodes lie in several components, other pairs may be links.  If
       more than FEW nodes lie outside the largest one, the nodes are compared with the
       one nearest to the hub instead, most often the text that the others were made from.
    4. Where few nodes remain outside the largest component around a hub, these are
       compared with all others; else `_sharing` finds the pairs that can be links.
    """
    stars = members.filter("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b"))
    checked = scratch.write(verify(stars.distinct()))
    links = checked.filter(F.col("similarity") >= threshold).select("a", "b")
    first = components(links, scratch)
    groups = scratch.write(_open(_around(checked), first))

    centre = groups.filter((F.col("outside") > FEW) & (F.col("node") != F.col("hub")))
    nearest = centre.groupBy("hub").agg(
        F.max(F.struct("similarity", (-F.col("node")).alias("late"))).alias("best")
    )
    turned = (
        groups.join(nearest.select("hub", (-F.col("best.late")).alias("a")), "hub")
        .filter(F.col("node") != F.col("a"))
        .select("a", F.col("node").alias("b"))
        .distinct()
    )
    again = scratch.write(verify(turned))
    links = links.unionByName(
        again.filter(F.col("similarity") >= threshold).select(
            F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
        )
    )
    second = components(links, scratch) if again.limit(1).count() else first
    small_groups = groups.filter(F.col("outside") <= FEW).select("hub", "node", "similarity")
    # A small group's hub may be the centre of another group as well; each node counts once.
    once = (
        small_groups.unionByName(_around(again))
        .groupBy("hub", "node")
        .agg(F.max("similarity").alias("similarity"))
    )
    open_ = scratch.write(_open(once, second))
    few = open_.filter(F.col("outside") <= FEW)
    x, y = few.filter("component <> largest").alias("x"), few.alias("y")
    apart = (
        (F.col("x.component") != F.col("y.component"))
        & (
            (F.col("y.component") == F.col("y.largest"))
            | (F.col("x.component") < F.col("y.component"))
        )
        # Distances 1 - similarity are a metric: a link's ends are about as far from a hub.
        & (F.abs(F.col("x.similarity") - F.col("y.similarity")) <= 1 - threshold + 1e-9)
    )
    near = x.join(y, (F.col("x.hub") == F.col("y.hub")) & apart).select(
        F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")
    )
    shared = _sharing(open_.filter(F.col("outside") > FEW), differ, threshold, scratch)
    known = checked.select("a", "b").unionByName(
        again.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    )
    rest = near.unionByName(shared).distinct().join(known, ["a", "b"], "left_anti")
    more = scratch.write(verify(rest)).filter(F.col("similarity") >= threshold).select("a", "b")
    if not more.limit(1).count():
        return second
    return components(links.unionByName(more), scratch)


def _around(checked: DataFrame) -> DataFrame:
    """(hub, node, similarity) of verified pairs, with a row for each hub itself."""
    around = checked.select(F.col("a").alias("hub"), F.col("b").alias("node"), "similarity")
    hubs = around.select("hub").distinct()
    return around.unionByName(
        hubs.select("hub", F.col("hub").alias("node"), F.lit(1.0).alias("similarity"))
    )


def _open(around: DataFrame, placed: DataFrame) -> DataFrame:
    """Hubs whose nodes lie in several components.

    Adds component, the largest one around the hub, and how many nodes lie outside it.
    """
    all_ = around.join(placed, "node", "left").select(
        "hub", "node", "similarity", F.coalesce("component", "node").alias("component")
    )
    several = (
        all_.groupBy("hub", "component")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("hub")
        .agg(
            F.max(F.struct("n", "component")).alias("top"),
            F.sum("n").alias("all"),
            F.count(F.lit(1)).alias("kinds"),
        )
        .filter("kinds > 1")
        .select(
            "hub",
            F.col("top.component").alias("largest"),
            (F.col("all") - F.col("top.n")).alias("outside"),
        )
    )
    return all_.join(several, "hub")


def _sharing(open_: DataFrame, differ: Differ, threshold: float, scratch: Scratch) -> DataFrame:
    """Pairs (a, b) of different components around a hub that share enough differences.

    Of hub h and node x, let R be what x lacks of h and D what it has beyond h.  Then
    |x & y| = |h| - |Rx| - |Ry| + |Rx & Ry| + |Dx & Dy|, and x, y are a link only if
    |x & y| >= w (|x| + |y|), with w = threshold / (1 + threshold).  So they share at least
    T = w (|x| + |y|) - |h| + |Rx| + |Ry| differences from h, where

        T >= w |x| + |Rx| - (1 - w) |h|       whatever y is,
        T >= (1 - w) |Rx| + w |Dx|            if y is not linked to h,

    and one of x, y is not, or they would be in one component.  Each node's differences are
    put in one order, rarest around the hub first.  Two nodes that share T of theirs share one
    among the first n - T + 1 of both.  At the first one they share, both
    have at least T left.  Copies of one text with changes of their own share hardly any, so
    that pairs do not grow with the square of their number.
    """
    w = threshold / (1 + threshold)
    pairs = open_.filter("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b"))
    lost, gained = F.size("lost"), F.size("gained")
    hub_size, size = F.col("size_a"), F.col("size_a") - lost + gained
    strong = F.greatest(F.lit(1), F.ceil((1 - w) * lost + w * gained - 1e-6))
    weak = F.greatest(F.lit(1), F.ceil(w * size + lost - (1 - w) * hub_size - 1e-6))
    n = lost + gained
    # Joined while there is one row per node: marks are many for a node that differs much.
    placed = open_.select(
        F.col("hub").alias("a"),
        F.col("node").alias("b"),
        "component",
        (F.col("similarity") >= threshold).alias("near"),
    )
    marks = differ(pairs).join(placed, ["a", "b"]).select(
        F.col("a").alias("hub"),
        F.col("b").alias("node"),
        "component",
        "near",
        (n - strong + 1).alias("strong"),
        (n - weak + 1).alias("weak"),
        n.alias("size"),
        (w * size + lost - hub_size / 2).alias("needs"),
        F.explode(
            F.concat(
                F.transform("lost", lambda e: F.xxhash64(F.lit("lost"), e)),
                F.transform("gained", lambda e: F.xxhash64(F.lit("gained"), e)),
            )
        ).alias("mark"),
    )
    marks = scratch.write(marks)
    common = marks.groupBy("hub", "mark").agg(F.count(F.lit(1)).alias("n"))
    own = Window.partitionBy("hub", "node").orderBy("n", "mark")
    ranked = (
        marks.join(common, ["hub", "mark"])
        .withColumn("rank", F.row_number().over(own))
        .filter((F.col("n") > 1) & (F.col("rank") <= F.greatest("strong", "weak")))
        .select(
            "hub",
            "mark",
            "node",
            "component",
            "near",
            (F.col("rank") <= F.col("strong")).alias("strong"),
            (F.col("rank") <= F.col("weak")).alias("weak"),
            (F.col("size") - F.col("rank") + 1).alias("left"),
            "needs",
        )
    )
    ranked = scratch.write(ranked)
    x, y = ranked.filter("not near").alias("x"), ranked.alias("y")
    # x is not linked to the hub, so y's rank is held to the stronger bound, and x's too
    # unless y is linked to the hub.
    may = F.col("y.strong") & F.when(F.col("y.near"), F.col("x.weak")).otherwise(
        F.col("x.strong") & (F.col("x.node") < F.col("y.node"))
    )
    return (
        x.join(
            y,
            (F.col("x.hub") == F.col("y.hub"))
            & (F.col("x.mark") == F.col("y.mark"))
            & (F.col("x.component") != F.col("y.component"))
            & may
            & (F.least("x.left", "y.left") >= F.col("x.needs") + F.col("y.needs") - 1e-6),
        )
        .select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))
    )
