"""Connected components of links, as alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import saved


def _large_star(links: DataFrame) -> DataFrame:
    """Every node hands its larger neighbours to the smallest node it knows."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least"))
    moved = both.where("b > a").join(least, "a")
    return moved.select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every node hands its smaller neighbours, and itself, to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    own = least.select("a", F.col("least").alias("b"))
    return moved.unionByName(own).where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node that a link (a, b) names; the component's smallest node.

    Each round is written, and a round reads the last one only. It ends when a round leaves the
    links as they are, after a number of rounds that grows with the logarithm of the longest path.
    """
    links = saved(links.where("a <> b").select("a", "b").distinct(), "links")
    state = None
    while True:
        links = saved(_small_star(_large_star(links)), "stars")
        row = links.agg(
            F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("digest")
        ).first()
        if (row["n"], row["digest"]) == state:
            break
        state = (row["n"], row["digest"])
    leaves = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return leaves.unionByName(roots)
