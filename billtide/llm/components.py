"""Connected components by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billtide.session import cut_lineage


def _large(edges: DataFrame) -> DataFrame:
    """Hangs every larger neighbour of a node on the node's smallest neighbour (or itself)."""
    both = edges.union(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    least = both.groupBy("src").agg(F.min("dst").alias("m"))
    least = least.select("src", F.least("src", "m").alias("m"))
    larger = both.where("dst > src").join(least, "src")
    return larger.select(F.col("dst").alias("src"), F.col("m").alias("dst")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    """Hangs a node and its smaller neighbours on the smallest of them; edges go from large to small."""
    least = edges.groupBy("src").agg(F.min("dst").alias("m"))
    smaller = edges.join(least, "src")
    hung = smaller.where("dst <> m").select(F.col("dst").alias("src"), F.col("m").alias("dst"))
    return hung.union(least.select("src", F.col("m").alias("dst"))).distinct()


def connected(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (src, dst); component is its smallest node.

    Null ends and loops are left out, repeated edges count once; no edges give no rows. Each round is cut
    off with a checkpoint in the shared folder. Rounds grow with the logarithm of the longest chain.
    """
    pairs = edges.where("src <> dst").select(
        F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")
    )
    pairs = cut_lineage(pairs.distinct())
    size = F.struct(F.count(F.lit(1)), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)")))
    seen = pairs.agg(size).first()[0]
    while True:
        pairs = cut_lineage(_small(_large(pairs)))
        now = pairs.agg(size).first()[0]
        if now == seen:
            break
        seen = now
    roots = pairs.select(F.col("dst").alias("node"), F.col("dst").alias("component")).distinct()
    return pairs.select(F.col("src").alias("node"), F.col("dst").alias("component")).union(roots)
