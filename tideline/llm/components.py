"""Connected components of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.tables import written



def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable over links (a, b); nodes without links give no row.

    Each round hangs a node's larger neighbours to its smallest one, and then the smaller neighbours and the node
    itself. Rounds halve the depth of what is connected, so their number grows with its logarithm. Only minima per
    node are grouped, which combines before the shuffle; each round is written, so a lost executor repeats one.
    """
    edges = written(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    while True:
        # Large star: neighbours larger than the node go to the smallest of all.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(large.distinct())
        # Small star: the smaller neighbours and the node itself go to the smallest of them.
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        hung = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(hung.unionByName(least.withColumnRenamed("m", "v")).distinct())
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node").unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        before = state
