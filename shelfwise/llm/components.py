"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.sources.shared import dropped, written



def components(edges: DataFrame) -> DataFrame:
    """Columns node and component (the least node of its component) for every node
    of the edges (a, b). Nodes are numbers.

    Every round each node hangs its larger neighbours, then its smaller ones, on
    the least node that it knows (large and small stars), until nothing changes.
    The grouping keeps a minimum per node only, so that a node with very many
    neighbours is no large group. Each round is written to the shared folder, and the one before goes.
    """
    edges = written(_ordered(edges), "edges")
    mark, before = _mark(edges), None
    while mark != before:
        last, edges = edges, written(_small_star(_large_star(edges)), "edges")
        dropped(last)
        mark, before = _mark(edges), mark
    children = edges.select(F.col("b").alias("node"), F.col("a").alias("component"))
    roots = edges.select(F.col("a").alias("node"), F.col("a").alias("component"))
    found = written(children.unionByName(roots).groupBy("node").agg(F.min("component").alias("component")), "components")
    dropped(edges)
    return found


def _mark(edges: DataFrame) -> tuple:
    """Differs for different sets of edges, but for a chance of 2**-64."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def _ordered(edges: DataFrame) -> DataFrame:
    """Each edge once, from the smaller node a to the larger b, loops left out."""
    return edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy(F.col("a").alias("center")).agg(F.least(F.min("b"), F.min("a")).alias("least"))
    hung = both.where("b > a").join(least, F.col("a") == F.col("center"))
    return _ordered(hung.select(F.col("least").alias("a"), "b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """On edges from smaller a to larger b: the center is b, its smaller neighbours
    and itself hang on the least of them."""
    least = edges.groupBy(F.col("b").alias("center")).agg(F.min("a").alias("least"))
    hung = edges.join(least, F.col("b") == F.col("center"))
    moved = hung.select(F.col("least").alias("a"), F.col("a").alias("b"))
    return _ordered(moved.unionByName(least.select(F.col("least").alias("a"), F.col("center").alias("b"))))
