"""Connected components of a graph of any size, by alternating stars.

Each round moves every node next to the smallest neighbour it knows: first the larger neighbours of
every node, then the smaller ones and the node itself. Both need one minimum per node and the edges
joined to it. A node with very many edges (a text with a third of all copies) is divided in ``SALTS``
parts by a hash of the other end: minima are taken by part, then by node, and handed back to the
parts that occur, so no task holds all edges of a node. A round ends in a written table; the driver
sees a count and a checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmart.sources.shared import stored

#: Parts that the edges of every node are divided in.
SALTS = 64


def with_least(edges: DataFrame, node: str, other: str) -> DataFrame:
    """``edges`` and ``m``: the smallest ``other`` of all edges with the same ``node``."""
    edges = edges.withColumn("_s", F.pmod(F.xxhash64(other), F.lit(SALTS)))
    parts = edges.groupBy(node, "_s").agg(F.min(other).alias("m"))
    low = parts.groupBy(node).agg(F.min("m").alias("m"), F.collect_list("_s").alias("_s"))
    return edges.join(low.withColumn("_s", F.explode("_s")), [node, "_s"]).drop("_s")


def _step(edges: DataFrame) -> DataFrame:
    """One large star and one small star over edges (a, b) with a > b."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    large = with_least(both, "u", "v").where("v > u")
    large = large.select(F.col("v").alias("a"), F.least("u", "m").alias("b"))
    small = with_least(large.distinct(), "a", "b")
    moved = small.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b")
    own = small.where("b = m").select("a", "b")
    return moved.unionByName(own).distinct()


def _sum(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b) but the roots; root is the smallest reached."""
    ordered = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = stored(ordered.where("a > b").distinct(), "edges")
    seen = _sum(now)
    while seen[0]:
        now = stored(_step(now), "edges")
        new = _sum(now)
        if new == seen:
            break
        seen = new
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
