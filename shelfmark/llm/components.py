"""Connected components of a distributed edge list, as union-find by alternating star steps. DataFrame operations only.

Each large step links every higher neighbour of a node to the lowest node around it, each small step links the lower neighbours
and the node itself; both keep components as they are and flatten their trees until every node points at its component's lowest
node. A step is one grouped minimum (combined before its shuffle) and one join, which adaptive execution splits where a centre is
hot, so no component ever meets in one task. Every step is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.scratch import discard, stage


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b: longs) to one row per node that has an edge to another: ``node`` and ``component``, its lowest node."""
    high, low = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    edges = stage(edges.filter("a <> b").select(high, low).distinct(), "edges")
    state = _state(edges)
    while state[0]:
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        # the node itself, if it is not its lowest, hangs below the lowest through the edge from that neighbour
        large = stage(large.filter("a <> b").distinct(), "large")
        discard(edges)
        least = large.groupBy("a").agg(F.min("b").alias("low"))
        linked = large.join(least, "a")
        small = linked.filter("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(least.select("a", F.col("low").alias("b")))
        edges = stage(small.distinct(), "small")
        discard(large)
        before, state = state, _state(edges)
        if state == before:
            break
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
