"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quitanda.llm.common import discard, written


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest node around it."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """Nodes of ``links`` (a, b) with ``root``, the smallest node of their component.

    Large and small stars take turns until all nodes of a component hang on its root, which
    takes about the logarithm of its size in rounds. Each round is a written table. Links of
    a node to itself are left out; roots have no row.
    """
    links = links.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    links, before = written(links.distinct(), "links"), None
    while True:
        state = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")))
        state = tuple(state.first())
        if state == before:
            return links.withColumnsRenamed({"a": "node", "b": "root"})
        before = state
        large = written(_large_star(links).distinct(), "links")
        discard(links)
        links = written(_small_star(large).distinct(), "links")
        discard(large)
