"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowvec.llm.common import write_table


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for all nodes of the edges ``a, b``; a component is its smallest node.

    Each round hangs larger neighbours, then smaller ones, on the smallest
    neighbour of each node, until every edge points to a smallest node.  Rounds
    grow with the logarithm of the size; each is written, so a lost executor
    costs one round.  Minima are combined before the shuffle and the joins can
    be split, so a node may have any share of the edges.
    """
    edges = write_table(_distinct(edges.where("a <> b")), "edges")
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = write_table(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m")), "least")
        large = write_table(_distinct(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))), "edges")
        # Each node of ``a`` now only has smaller neighbours.
        least = write_table(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        moved = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = write_table(_distinct(moved.unionByName(least.select("a", F.col("m").alias("b")))), "edges")
        edges = small
        # Done once every node either hangs on one other or is hung on.
        roles = edges.select(F.col("a").alias("node"), F.lit(1).alias("hangs"), F.lit(0).alias("holds"))
        roles = roles.unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("hangs"), F.lit(1).alias("holds")))
        roles = roles.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
        if not roles.where("hangs > 1 or (hangs = 1 and holds = 1)").limit(1).count():
            break
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return nodes.unionByName(roots)


def _distinct(edges: DataFrame) -> DataFrame:
    """Edges from the larger to the smaller node, once each."""
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
