"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.joins import equal_keys
from tidemark.session import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Ties the larger neighbours of each node to the smallest node around it."""
    both = edges.select("a", "b").union(edges.select("b", "a")).toDF("u", "v")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")).withColumnRenamed("u", "of")
    larger = both.filter("v > u")
    joined = larger.join(least, equal_keys(larger, least, {"u": "of"}))
    return joined.select(F.col("m").alias("a"), F.col("v").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Ties each node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("b").agg(F.min("a").alias("m")).withColumnRenamed("b", "of")
    joined = edges.join(least, equal_keys(edges, least, {"b": "of"}))
    moved = joined.filter("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b"))
    return moved.union(least.select(F.col("m").alias("a"), F.col("of").alias("b"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node that has an edge; the root is the component's smallest node.

    ``edges`` holds ``a < b``.  Large and small stars in turn, written to the
    shared folder, until nothing changes: the depth shrinks geometrically and
    a node with very many edges only ever meets one row in a join, which AQE
    may split.  An empty graph gives no rows.
    """
    state = written(edges.select("a", "b").distinct(), "edges")
    mark = None
    while True:
        found = state.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(found) == mark:
            return state.select(F.col("b").alias("node"), F.col("a").alias("root")).union(
                state.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
            )
        mark = tuple(found)
        state = written(_small_star(written(_large_star(state), "edges")), "edges")
