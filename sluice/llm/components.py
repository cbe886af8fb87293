"""Connected components of a distributed edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _to_least(pairs: DataFrame) -> DataFrame:
    """Each (u, v) with the least of u and its partners. A node with many partners leaves every map
    task as one row of the aggregate; that is written, so that both sides of the join are plain scans
    and adaptive execution splits such a node there."""
    least = stored(pairs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "least")
    return pairs.join(least, "u")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); root is the least node of its component.

    Alternates the large-star and the small-star step until the edges form stars: large-star moves
    a node's larger partners to its least one, small-star its smaller partners. Both keep the
    components, and the number of rounds grows with the logarithm of the longest chain. Each round
    is written to the shared folder; the driver sees a count and a checksum only.

    Edges with a null end and loops say nothing and are ignored.
    """
    state = stored(
        edges.where("a is not null and b is not null and a != b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    while True:
        mark = state.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before or not mark[0]:
            break
        before = mark
        both = state.union(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = stored(_to_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "edges")
        small = _to_least(large)
        ends = F.explode(F.array("u", "v"))
        state = stored(
            small.select("m", ends.alias("u")).where("u != m").select("u", F.col("m").alias("v")).distinct(), "edges")
    return state.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        state.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
