"""Connected components of a graph whose links nobody collects."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, stored


def _size_and_shape(edges: DataFrame) -> tuple[int, bool]:
    """Number of edges (u, v) with u > v; whether they are stars: each u has one v, and no v is a u."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(edges.select(F.col("v"), F.lit(0), F.lit(1)))
    by_node = ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    row = by_node.agg(F.coalesce(F.sum("up"), F.lit(0)).alias("n"), F.count_if((F.col("up") > 1) | (F.col("up") > 0) & (F.col("down") > 0)).alias("bent")).head()
    return row["n"], not row["bent"]


def components(links: DataFrame) -> DataFrame:
    """links (a, b: long) → node, root: the least node that is reachable, for every node that has a link. A stored table.

    Alternating large-star and small-star steps (each node's larger neighbours, then its smaller ones, are
    linked to its least neighbour) until the links are stars; the number of steps grows with the logarithm
    of the component size. Minima are aggregated before they are shuffled, and the joins that send
    them back have one row for each node on one side, so that a hot node is split. Each step's table replaces the one before. Links from
    a node to itself and null ends are ignored.
    """
    edges = links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = stored(edges, "edges")
    n, done = _size_and_shape(edges)
    while not done:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        large = both.join(least, F.col("u") == F.col("k")).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.where(F.col("u") != F.col("v")).distinct(), "large-star", n)
        discard(edges)
        least = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), "m")
        small = large.join(least, F.col("u") == F.col("k")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(small.union(least.select(F.col("k").alias("u"), F.col("m").alias("v"))).where(F.col("u") != F.col("v")).distinct(), "small-star", 2 * n)
        discard(large)
        n, done = _size_and_shape(edges)
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select("v", "v").distinct())
    roots = stored(nodes, "roots", 2 * n)
    discard(edges)
    return roots
