"""Connected components of a link table by alternating large and small stars.

Every step is an aggregate by node and a join on it; each round is written to the shared folder. No group of
neighbours is ever collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafline.llm.common import discard, stored


def _large(links: DataFrame) -> DataFrame:
    """Link each larger neighbour of a node to the smallest node around it; where that is the node, nothing moves."""
    around = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = around.groupBy("u").agg(F.min("v").alias("m")).where("m < u")
    larger = around.where("v > u")
    moved = larger.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    kept = larger.join(least.select("u"), "u", "left_anti").select(F.col("v").alias("u"), F.col("u").alias("v"))
    return moved.unionByName(kept)


def _small(links: DataFrame) -> DataFrame:
    """Link the smaller neighbours of a node, and the node, to the smallest of them."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in ``links`` (columns a, b): the smallest node reachable.

    Self-links and repeated links are harmless; an empty table gives an empty result.
    """
    links = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    links = stored(links.distinct(), "links")
    before = None
    while True:
        state = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % 1_000_003), F.sum("v")).first()
        if state == before or not state[0]:
            return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        before = state
        earlier, links = links, stored(_small(_large(links).distinct()).distinct(), "links")
        discard(earlier)
