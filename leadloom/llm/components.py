"""Connected components of a graph of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage


def _lowest(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.min("v").alias("m"))


def _joined(pairs: DataFrame, lowest: DataFrame) -> DataFrame:
    """Each pair with the lowest neighbour of its ``u``.

    The hash beside the key gives both sides a shuffle of their own, which adaptive
    execution can split where one node has a large part of the links.
    """
    right = lowest.select(F.col("u").alias("node"), "m", F.xxhash64("u").alias("node_hash"))
    left = pairs.withColumn("u_hash", F.xxhash64("u"))
    return left.join(right, (F.col("u") == F.col("node")) & (F.col("u_hash") == F.col("node_hash"))).select(
        "u", "v", "m"
    )


def connected_components(links: DataFrame) -> DataFrame:
    """The lowest node that each linked node reaches.

    ``links`` has two long columns ``u`` and ``v``; the result has ``node`` and ``root``,
    one row per node that has a link to another one. Roots are nodes too (root = node).
    Each round halves the depth of the trees and keeps one link per node and tree, so the
    number of links falls. Every round is written to the staging folder: a lost executor
    costs one round, and plans stay short. No links give no rows.
    """
    edges = stage(
        links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct()
    )
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = _lowest(both).select("u", F.least("u", "m").alias("m"))
        # Every higher neighbour of u is tied to the lowest node around u.
        large = _joined(both, lowest).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stage(large)
        # Every lower neighbour of u, and u itself, are tied to the lowest of them.
        tied = _joined(large, _lowest(large))
        small = tied.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = stage(small.unionByName(_lowest(large).select("u", F.col("m").alias("v"))).distinct())
        # Done when nothing is tied to a node that is itself tied to a lower one.
        open_ends = small.join(small.select(F.col("u").alias("w")).distinct(), F.col("v") == F.col("w"), "left_semi")
        several = small.groupBy("u").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        edges = small
        if open_ends.isEmpty() and several.isEmpty():
            break
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
