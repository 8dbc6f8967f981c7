"""Connected components of a large edge list, as joins and aggregations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselens.llm.common import landed


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _smallest(edges: DataFrame) -> DataFrame:
    return edges.groupBy("a").agg(F.min("b").alias("low"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest node of its neighbourhood."""
    both = _both_ways(edges)
    low = _smallest(both).select("a", F.least("a", "low").alias("low"))
    return (
        both.join(low, "a")
        .filter(F.col("b") > F.col("a"))
        .select(F.col("b").alias("a"), F.col("low").alias("b"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are tied to the smallest of them."""
    low = _smallest(edges)
    moved = edges.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.filter("a <> b").union(low.select("a", F.col("low").alias("b"))).distinct()


def _print_of(edges: DataFrame) -> tuple:
    """A set of edges told from others by its size and an order-free sum of hashes."""
    hashed = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(hashed)).first())


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the edges ``(a, b)``; root is the smallest node it reaches.

    Alternates large-star and small-star steps until nothing moves, about log(n) rounds. A hub's
    edges are combined before the shuffle; the joins have one row per node on one side, so a hub
    can be split by adaptive execution. Each round is a table in the shared folder. Roots do not
    appear as nodes. Loops ``(a, a)`` and repeated edges change nothing; no edges give no rows.
    """
    ordered = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    # A small-star step first: nodes of a dense group share their few smallest neighbours, so most
    # edges become equal before any is looked at from both sides.
    current = landed(_small_star(landed(ordered.filter("a <> b").distinct())))
    before = _print_of(current)
    while before[0]:
        current = landed(_small_star(_large_star(current)))
        now = _print_of(current)
        if now == before:
            break
        before = now
    return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
