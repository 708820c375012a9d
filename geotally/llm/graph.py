"""Connected components by alternating large and small stars; every round is written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, written


def _lowest(edges: DataFrame) -> DataFrame:
    return edges.groupBy("a").agg(F.min("b").alias("low"))


def components(edges: DataFrame) -> DataFrame:
    """``edges(a long, b long)`` -> one row (node, component) per node with an edge; component is the smallest node.

    A round first ties each node's larger neighbours to its smallest neighbour, then its smaller ones, which halves
    the depth of every tree; minima are aggregated before the shuffle, so a node of very many edges is no hot spot.
    Null ends and loops are ignored. An empty table gives an empty result.
    """
    now = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    state = None
    while True:
        count = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if count == state or not count[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select("b", "b").distinct()) if count[0] else now.select(F.col("a").alias("node"), F.col("b").alias("component"))
        state = count
        both = now.union(now.select("b", "a"))
        low = _lowest(both).select("a", F.least("a", "low").alias("low"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        # A node that is itself the smallest keeps its edges; every edge now points from a larger to a smaller node.
        large = written(large.where("a <> b").distinct(), "edges")
        low = _lowest(large)
        small = large.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("low").alias("b")), F.struct(F.col("b").alias("a"), F.col("low").alias("b")))).alias("e")).select("e.a", "e.b")
        before, now = now, written(small.where("a <> b").distinct(), "edges")
        discard(before)
        discard(large)
