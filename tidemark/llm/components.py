"""Connected components of a graph given by its edges, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import stored


def star(edges: DataFrame, larger: bool) -> DataFrame:
    """Every node links its neighbours to the smallest node around it.

    With ``larger`` only neighbours above the node move, without it the node and those below.
    """
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    if larger:
        moved = both.where("b > a").join(least, "a").select(F.col("b").alias("x"), "m")
        return moved.where("x <> m").select(F.col("x").alias("a"), F.col("m").alias("b")).distinct()
    downward = both.where("b < a")
    centres = downward.groupBy("a").agg(F.min("b").alias("m"))
    moved = downward.join(centres, "a").select(F.col("b").alias("x"), "m")
    own = centres.select(F.col("a").alias("x"), "m")
    return moved.unionAll(own).where("x <> m").select(F.col("x").alias("a"), F.col("m").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) for every node of ``edges`` (``a``, ``b``).

    The steps halve the distance to the smallest node about each time; all is done in tables of
    the size of the edges, and a table is written after every pair of steps.
    """
    edges = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    while True:
        moved = stored(star(star(edges, larger=True), larger=False), "edges")
        # Done when every node points at a node that points nowhere.
        if moved.select("a").join(moved.select(F.col("b").alias("a")), "a", "left_semi").isEmpty() and moved.groupBy("a").count().where("count > 1").isEmpty():
            break
        edges = moved
    roots = moved.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return stored(moved.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(roots), "components")
