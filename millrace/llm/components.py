"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.storage import materialize


def _both_ways(links: DataFrame) -> DataFrame:
    return links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(links: DataFrame) -> DataFrame:
    """Larger neighbours of each node move to its smallest neighbour."""
    near = _both_ways(links)
    least = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    moved = near.filter("b > a").join(least, "a").select(F.col("b").alias("a"), "least")
    return moved.select("a", F.col("least").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Smaller neighbours of each node, and the node, move to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    own = least.select("a", F.col("least").alias("b"))
    return moved.unionByName(own).filter("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for each node of ``links(a, b)``; the root is the smallest node.

    Every step is written to the shared folder, so lineage stays short and a
    lost executor costs one step.  A node with very many links is summed
    before the shuffle, and the join back can be split.  No links: empty.
    """
    current = materialize(links.filter("a <> b").select("a", "b").distinct(), "links")
    seen = None
    while True:
        state = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_003)).first()
        if state == seen:
            break
        seen = state
        current = materialize(_small_star(_large_star(current)), "links")
    roots = current.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root"))
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
