"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketgrain.llm import common


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _towards_least(edges: DataFrame) -> DataFrame:
    """One round of large-star and small-star: every edge moves to the least
    neighbour. A hub's edges are never gathered: its least neighbour is added up
    before the shuffle and joined back, which adaptive execution splits."""
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    large = both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    large = large.where(F.col("a") != F.col("b"))
    down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    small = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(least.select("a", F.col("m").alias("b")))
    return small.where(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges a-b; the root is the least node.

    Each round is written to the shared folder, which cuts the lineage. No edges
    give no rows."""
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    edges = common.stored(edges, "components")
    state = _fingerprint(edges)
    while state[0]:
        edges = common.stored(_towards_least(edges), "components")
        was, state = state, _fingerprint(edges)
        if was == state:
            break
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionAll(edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
