"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.sources.warehouse import settle


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the (a, b) edges; component is the smallest node reachable.

    In each round every node joins its smallest neighbour, if that is smaller, and edges are
    drawn anew between the joined nodes, until none is left. A node's way through the rounds is
    followed at the end. Rounds are written tables; edges at least lose every node that is not
    smaller than all its neighbours, so few rounds are needed. Edges of a null end count as none.
    """
    rest = edges.where("a is not null and b is not null and a <> b").select("a", "b").distinct()
    rest = settle(rest, "graph_edges")
    nodes = rest.select(F.col("a").alias("node")).unionByName(rest.select(F.col("b").alias("node"))).distinct()
    steps = []
    while not rest.isEmpty():
        both = rest.unionByName(rest.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("from")).agg(F.min("b").alias("to"))
        parents = settle(least.where(F.col("to") < F.col("from")), "graph_parents")
        steps.append(parents)
        for end in ("a", "b"):
            rest = rest.join(parents, F.col(end) == F.col("from"), "left").withColumn(end, F.coalesce("to", end)).select("a", "b")
        rest = rest.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        rest = settle(rest, "graph_edges")
    # A parent may itself have a parent in the same round, so each step is followed to its end.
    found = nodes.withColumn("component", F.col("node"))
    for parents in steps:
        found = _follow(found, parents)
    return found


def _follow(found: DataFrame, parents: DataFrame) -> DataFrame:
    moved = found.join(parents, F.col("component") == F.col("from"), "left")
    return moved.select("node", F.coalesce("to", "component").alias("component"))
