"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved


def _links(edges: DataFrame) -> DataFrame:
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()


def _lowest(pairs: DataFrame) -> DataFrame:
    """The smallest of each node and its neighbours, by node; partial minima first."""
    return pairs.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of all nodes of the edges (a, b); root is the smallest reachable node.

    Every round links each node's larger neighbours, then its smaller ones, to the
    smallest of its neighbours, as joins and minima over the edge table; a node
    with very many neighbours is a skewed join side, which Spark splits. It ends
    when every edge leads straight to its root.
    """
    now = saved(_links(edges), "edges")
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = both.join(_lowest(both), "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        now = saved(_links(large), "large")
        low = _lowest(now)
        small = now.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(low.select("a", F.col("low").alias("b")))
        now = saved(_links(small), "small")
        # a star forest: nobody has two roots, and no root has one
        two = now.groupBy("a").count().where("count > 1").limit(1)
        chain = now.select("b").distinct().join(now.select(F.col("a").alias("b")), "b", "left_semi").limit(1)
        if not two.unionByName(chain.select(F.col("b").alias("a"), F.lit(1).cast("long").alias("count"))).head(1):
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
