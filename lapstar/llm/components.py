"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapstar.session import save

ROUNDS = 100


def _least_neighbour(pairs: DataFrame) -> DataFrame:
    """Joins to each pair ``(u, v)`` the least of ``u`` and its neighbours."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return pairs.join(least, "u")


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges`` (``a``, ``b``); a component is named by its least node.

    Large-star and small-star steps in turn: each node's greater neighbours are hung on its least neighbour, then its
    smaller ones, until nothing moves. Minima are combined before the shuffle, so a node may have any number of edges.
    """
    a, b = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    edges = save(edges.filter("a <> b").select(a, b).distinct(), "edges")
    state = None
    for _ in range(ROUNDS):
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
        both = both.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = _least_neighbour(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = _least_neighbour(large)
        hung = small.select(F.col("m").alias("a"), F.col("v").alias("b")).unionByName(
            small.select(F.col("m").alias("a"), F.col("u").alias("b"))
        )
        edges = save(hung.filter("a <> b").distinct(), "edges")
        before, state = state, edges.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))
        ).first()
        if state == before:
            break
    else:
        raise RuntimeError("the components did not settle")
    nodes = edges.select(F.col("b").alias("node"), F.col("a").alias("component"))
    return nodes.unionByName(edges.select(F.col("a").alias("node"), F.col("a").alias("component"))).distinct()
