"""Connected components of a graph held in tables, without a driver-side union-find.

Each round every node hooks to its smallest neighbour, if that is smaller (a forest, as parents
are smaller), trees are flattened by pointer jumping, and the edges are drawn between roots.
Nodes that stay are local minima, at most half of all, so rounds are logarithmic. Every step is
a minimum with map-side combining or a join of written tables, where Spark splits hot nodes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kessan.session import written


def _flattened(forest: DataFrame) -> DataFrame:
    """``node, parent`` with every parent a root."""
    while True:
        above = forest.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
        jumped = written(
            forest.join(above, "parent").select(
                "node", F.col("above").alias("parent"), (F.col("above") != F.col("parent")).alias("moved")
            ),
            "forest",
        )
        forest = jumped.select("node", "parent")
        if jumped.filter("moved").isEmpty():
            return forest


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of the undirected ``edges`` (``a, b``); nodes of one
    component share one root. No edges give an empty table; loops and repeats do no harm."""
    levels = []
    edges = written(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        hooked = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
        forest = _flattened(written(hooked.select("node", F.least("node", "least").alias("parent")), "forest"))
        levels.append(forest)
        first = forest.select(F.col("node").alias("a"), F.col("parent").alias("x"))
        second = forest.select(F.col("node").alias("b"), F.col("parent").alias("y"))
        between = edges.join(first, "a").join(second, "b").filter("x <> y")
        edges = written(
            between.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges"
        )
    if not levels:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    labels = levels.pop().withColumnRenamed("parent", "root")
    for forest in reversed(levels):
        higher = labels.withColumnRenamed("node", "parent")
        labels = written(
            forest.join(higher, "parent", "left").select("node", F.coalesce("root", "parent").alias("root")), "labels"
        )
    return labels
