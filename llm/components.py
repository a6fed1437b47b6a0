"""Distributed union-find: connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.scratch import Scratch


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component): the smallest node reachable from each linked node.

    `links` has columns `a` and `b` of one ordered type.  Nodes without links are not
    returned, nor does a component's smallest node get a row of its own.

    Each round hangs the larger neighbours of every node below its smallest neighbour
    (large star), then the smaller ones (small star).  Trees get shallower every
    round until all are stars, which takes a logarithmic number of rounds, two or
    three for links that are stars already.  Minima are pre-aggregated; a node with very many links
    is one hot key of an ordinary join, which adaptive execution splits.
    """
    pairs = links.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
    edges = scratch.write(pairs.filter("hi <> lo").distinct())
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        nearest = both.groupBy("hi").agg(F.min("lo").alias("nearest"))
        large = (
            both.join(nearest, "hi")
            .select("hi", "lo", F.least("nearest", "hi").alias("root"))
            .filter("lo > hi")
            .select(F.col("lo").alias("hi"), F.col("root").alias("lo"))
            .distinct()
        )
        lowest = large.groupBy("hi").agg(F.min("lo").alias("root"))
        hung = large.join(lowest, "hi").select("lo", "root").filter("lo <> root")
        after = scratch.write(
            hung.select(F.col("lo").alias("hi"), F.col("root").alias("lo"))
            .unionByName(lowest.select("hi", F.col("root").alias("lo")))
            .distinct()
        )
        scratch.drop(edges)
        edges = after
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("component"))


def _stars(edges: DataFrame) -> bool:
    """Whether every node hangs below one node that hangs below none."""
    rooted = edges.groupBy("hi").agg(F.count(F.lit(1)).alias("n"))
    twice = rooted.filter("n > 1").limit(1).count()
    if twice:
        return False
    return not edges.join(edges.select(F.col("hi").alias("lo")), "lo", "left_semi").limit(1).count()
