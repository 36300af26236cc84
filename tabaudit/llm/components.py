"""Connected components of a graph in a table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tabaudit.session import materialize


def _apart(table: DataFrame) -> DataFrame:
    """``table`` in a shuffle of its own, so that a join with it can split nodes with many edges."""
    return table.hint("rebalance")


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang each node and its smaller neighbours under the smallest of them."""
    least = _apart(edges.groupBy("a").agg(F.min("b").alias("m")))
    moved = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", "m")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang the larger neighbours of each node under its smallest neighbour, or under itself."""
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    least = _apart(least)
    return (
        both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    ).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) of every node with an edge.

    ``edges`` has two long columns, in any direction, repeats allowed. Each round
    is written to the shared folder; the rounds grow with the logarithm of a
    component's size. Joins are on nodes, whose rows adaptive execution splits
    where one node has very many neighbours.
    """
    a, b = edges.columns
    edges = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
    edges = materialize(edges.filter("a <> b").distinct(), "edges")
    state = None
    while True:
        edges = materialize(_small_star(_large_star(edges)), "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % (1 << 40))).first()
        if now == state:
            break
        state = now
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return stars.union(roots)
