"""Connected components of a large edge table by alternating large-star and
small-star steps, each a join and an aggregation that Spark distributes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewash.llm.common import staged


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v, both long): root is the
    smallest node reachable. Nodes without an edge are not listed.

    Each step replaces a node's neighbours by links to the smallest one; the
    number of steps grows with the logarithm of the longest path. Every step
    is written to the checkpoint folder, so a lost executor costs one step at
    most. A node with very many links costs one aggregated row per task and a
    join that adaptive execution can split; its neighbours are never gathered
    in one place.
    """
    e = staged(edges.where("u <> v").select(F.least("u", "v").alias("v"), F.greatest("u", "v").alias("u")).distinct(),
               "cc")
    seen = None
    while True:
        # large star: every neighbour above u is linked to the least node around u
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: u and its lesser neighbours are linked to the least of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        e = staged(small, "cc")
        state = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
