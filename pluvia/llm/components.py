"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvia.llm.common import staged


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours are linked to the smallest node it knows."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return (both.where("v > u").join(low, "u")
            .select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are linked to the smallest of them."""
    low = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = (edges.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
             .where("a <> b"))
    return moved.unionAll(low.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges(a, b)``; the root is the smallest node
    reachable.  Nodes that are a root themselves have no row.

    Each round is written to the shared folder; only a row count and a checksum reach
    the driver.  Minima are combined before they are shuffled and joins may be split by
    AQE, so a node with very many links does not land in one task.
    """
    ordered = edges.where("a <> b").select(F.greatest("a", "b").alias("a"),
                                           F.least("a", "b").alias("b"))
    current = staged(ordered.distinct(), "components")
    state = _state(current)
    while state[0]:
        following = staged(_small_star(_large_star(current)), "components")
        new = _state(following)
        if new == state:
            break
        current, state = following, new
    return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
