"""Connected components of a large graph by alternating large-star and small-star steps.

Each step replaces edges by edges to the smallest neighbour; the edge set never grows beyond its
first size, and after a logarithmic number of rounds every node points at its component's smallest
node. Smallest neighbours come from partial aggregation and are joined back, so a node with very many
neighbours is one that adaptive skew handling splits. Each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeworks.llm.shared import discard, written


def _star(edges: DataFrame, both_ways: bool) -> DataFrame:
    """edges: (u, v) with u > v. both_ways: large star, else small star."""
    near = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if both_ways else edges
    least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = near.join(least, "u")
    if both_ways:
        moved = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return moved.where("u > v").distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of `edges` (columns a and b, long); root is the component's smallest
    node. Null ends, loops and repeated edges are ignored."""
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now, mark = written(now, "edges"), None
    for _ in range(max_rounds):
        old, now = now, written(_star(_star(now, True), False), "edges")
        discard(old)
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if seen == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        mark = seen
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
