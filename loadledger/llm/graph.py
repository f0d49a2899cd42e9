"""Connected components of a large graph, by alternating stars.

Each round hangs every node's neighbours under the smallest node it knows, first the larger ones,
then the smaller ones, until the edges form stars. A round is two aggregates and two joins over the
edges, and its result is written to the shared folder; nothing is gathered in the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadledger.work import cut_lineage


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node it is connected with, for nodes that have an edge.

    ``edges`` has two columns of one comparable type. Loops and null ends count for nothing.
    """
    u, v = edges.columns
    stars = edges.select(F.greatest(u, v).alias("node"), F.least(u, v).alias("root"))
    stars = cut_lineage(stars.where((F.col(u) != F.col(v))).distinct())
    before = None
    while (now := _mark(stars)) != before:
        before = now
        stars = cut_lineage(_small_star(cut_lineage(_large_star(stars))))
    roots = stars.select(F.col("root").alias("node"), "root").distinct()
    return stars.unionByName(roots)


def _mark(edges: DataFrame) -> tuple:
    """Tells one set of distinct edges from another."""
    total = F.sum(F.xxhash64("node", "root").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), total).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("root").alias("node"), F.col("node").alias("root")))
    least = both.groupBy("node").agg(F.min("root").alias("_least"))
    least = least.select(F.col("node").alias("_node"), F.least("node", "_least").alias("_least"))
    hung = both.where("root > node").join(least, F.col("node") == F.col("_node"))
    return hung.select(F.col("root").alias("node"), F.col("_least").alias("root")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("node").agg(F.min("root").alias("_least")).withColumnRenamed("node", "_node")
    hung = edges.join(least, F.col("node") == F.col("_node"))
    others = hung.where("root <> _least").select(F.col("root").alias("node"), F.col("_least").alias("root"))
    own = least.select(F.col("_node").alias("node"), F.col("_least").alias("root"))
    return others.unionByName(own).distinct()
