"""Links around a hub that is also the centre of a larger group, against brute force."""

from __future__ import annotations

from pyspark.sql import functions as F

from llm.linking import FEW, bucket_members, linked
from llm.scratch import Scratch
from tests.llm.conftest import jaccard_links

CENTRE = 100


def _sets():
    """A first node, the centre, and ten nodes far from it, of which two are linked.

    These two share four differences from the centre, and each has two of its own.
    """
    base = set(range(20))
    sets = {1: base - {19}, CENTRE: base}
    shared = (base - {0, 1}) | {1000, 1001}
    sets[101] = shared | {1010, 1011}
    sets[102] = shared | {1020, 1021}
    for k in range(8):
        own = {2000 + 10 * k + i for i in range(4)}
        sets[103 + k] = (base - {2 + 2 * k, 3 + 2 * k}) | own
    return sets


def test_hub_of_a_small_and_centre_of_a_large_group(spark):
    sets = _sets()
    large, small = sorted(sets), [CENTRE, *range(101, 109)]
    assert len(small) - 1 <= FEW < len(large) - 2
    scratch = Scratch(spark, "test")
    buckets = [(1, n) for n in large] + [(2, n) for n in small]
    members = bucket_members(spark.createDataFrame(buckets, "bucket bigint, node bigint"))
    rows = spark.createDataFrame([(n, sorted(s)) for n, s in sets.items()], "n bigint, s array<int>")
    left = rows.select(F.col("n").alias("a"), F.col("s").alias("sa"))
    right = rows.select(F.col("n").alias("b"), F.col("s").alias("sb"))

    def verify(pairs):
        similarity = F.size(F.array_intersect("sa", "sb")) / F.size(F.array_union("sa", "sb"))
        return pairs.join(left, "a").join(right, "b").select("a", "b", similarity.alias("similarity"))

    def differ(pairs):
        return (
            pairs.join(left, "a")
            .join(right, "b")
            .select(
                "a",
                "b",
                F.size("sa").cast("bigint").alias("size_a"),
                F.array_except("sa", "sb").alias("lost"),
                F.array_except("sb", "sa").alias("gained"),
            )
        )

    placed = {r.node: r.component for r in linked(scratch.write(members), verify, differ, 0.8, scratch).collect()}
    links = jaccard_links([frozenset(sets[n]) for n in large], 0.8)
    want = {n: large[links.find(i)] for i, n in enumerate(large)}
    assert want[101] == want[102] != want[103]
    assert {n: placed.get(n, n) for n in large} == want
