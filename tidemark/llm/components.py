"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star: neighbours of each node link to its smallest neighbour instead. ``edges``: u > v, distinct."""
    if large:  # every node with all its neighbours; the larger ones move
        sides = edges.select(F.col("u").alias("n"), F.col("v").alias("x")).unionByName(edges.select(F.col("v").alias("n"), F.col("u").alias("x")))
        low = sides.groupBy("n").agg(F.min("x").alias("low"))
        moved = sides.join(low, "n").where("x > n").select(F.col("x").alias("u"), F.least("low", "n").alias("v"))
    else:  # every node with its smaller neighbours, and itself
        low = edges.groupBy("u").agg(F.min("v").alias("low"))
        met = edges.join(low, "u")
        moved = met.select(F.when(F.col("v") == F.col("low"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("low").alias("v"))
    return moved.where("u > v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root for every node of ``edges`` (a, b: long): root is the smallest node of its component.

    Each star is a partial aggregate and a join, so a node with very many neighbours is reduced in every task and its
    join partition can be split. The edge list never grows; rounds grow with the logarithm of the size.
    """
    now = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct()
    now = stored(now, "edges")
    before = None
    while True:
        now = stored(_star(_star(now, True), False), "edges")
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_003), F.sum(F.xxhash64("v", "u") % 998_244_353)).first()
        if mark == before:
            break
        before = mark
    leaves = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return leaves.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
