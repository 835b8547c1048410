"""Connected components of a graph given by edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystar.llm.common import stored


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node reachable, for every node with an edge.

    ``edges`` has long columns a and b.  Each round links every node's larger neighbours
    to its smallest one, then every node's smaller neighbours likewise, until nothing
    changes; the number of rounds grows with the logarithm of the longest chain.  Only
    one number per round reaches the driver.
    """
    pairs = stored(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    for _ in range(max_rounds):
        both = pairs.union(pairs.select(F.col("b"), F.col("a")))
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        # Large star: larger neighbours of a node point to its smallest neighbour.
        large = (
            both.join(lowest, "a").where("b > a")
            .select(F.col("b").alias("a"), F.col("low").alias("b")).distinct())
        # Small star: a node and its smaller neighbours point to the smallest of them.
        least = large.groupBy("a").agg(F.min("b").alias("low"))
        small = (
            large.join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
            .union(least.select("a", "low")).where("a <> b").distinct())
        pairs = stored(small)
        mark = pairs.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    members = pairs.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node")
    roots = members.select(F.col("component").alias("node"), "component").distinct()
    return members.union(roots)
