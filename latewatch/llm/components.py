"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latewatch.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: longs), ``root`` the smallest node of its component.

    Each step joins nodes with the minimum of their neighbours, which is aggregated before it is shuffled; a hub is one row
    on the small side. Every round is written to the shared folder; it ends when a round changes no edge. The number of
    rounds grows with the logarithm of the longest path, whatever the number of nodes.
    """
    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = _mark(now)
    while True:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        now = written(small.where("a <> b").distinct(), "edges")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    roots = now.groupBy("a").agg(F.min("b").alias("root"))
    return roots.select(F.col("a").alias("node"), "root").union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _mark(edges: DataFrame) -> tuple:
    """Number of edges and a sum of their hashes: equal for equal tables."""
    return tuple(edges.select(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first())
