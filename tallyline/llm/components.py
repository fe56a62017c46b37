"""Connected components of a table of links: alternating large-star and small-star steps, all of them joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.frames import settled


def _star(edges: DataFrame, outward: bool) -> DataFrame:
    """Link neighbours to the smallest node around: those above a node (outward), or those below it."""
    seen = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if outward else edges
    least = seen.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("m")).withColumn("m", F.least("m", "node"))
    around = seen.join(least, F.col("u") == F.col("node"))
    if outward:
        moved = around.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = around.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select(F.col("node").alias("u"), F.col("m").alias("v")))
    return moved.filter(F.col("u") != F.col("v")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of links (u, v): root is the smallest node it can reach.

    Links may repeat, point either way or from a node to itself; a node with no other neighbour gets no row.
    """
    edges = settled(
        links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter(F.col("u") != F.col("v")).distinct())
    mark = None
    while True:
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first()
        if now == mark or not now[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        mark = now
        edges = settled(_star(_star(edges, True), False))
