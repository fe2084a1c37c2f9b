"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import saved


def connected_components(edges: DataFrame) -> DataFrame:
    """Rows (node, root) for every node of ``edges`` (a, b), root being the
    smallest node of its component.

    Each step links nodes to the least neighbour known; the number of steps
    grows with the logarithm of the nodes. A step's result is written to the
    shared folder. The least neighbour is a partial aggregate and comes back
    by a join, so a node with very many neighbours is neither gathered in one
    task nor expanded to pairs.
    """
    links = edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
    links = saved(links, "cc")
    mark = _mark(links)
    while True:
        links = saved(_small_star(_large_star(links)), "cc")
        now = _mark(links)
        if now == mark:
            break
        mark = now
    roots = links.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def _mark(links: DataFrame):
    r = links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("hi", "lo")), F.bit_xor(F.hash("lo", "hi"))).first()
    return tuple(r)


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's least neighbour."""
    both = links.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
        links.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
            .distinct())


def _small_star(links: DataFrame) -> DataFrame:
    """A node's smaller neighbours, and the node, are linked to the least of them."""
    least = links.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = links.join(least, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return moved.unionByName(least.select("hi", F.col("m").alias("lo"))).distinct()
