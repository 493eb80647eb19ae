"""Connected components of a large edge list by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txwatch.session import materialise


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the undirected edges (a, b), long ids; component is the smallest node.

    Each round points every node at its smallest neighbour, follows pointers twice, and contracts the edges;
    at least halves the nodes that still have edges. All steps are combinable aggregates and joins whose
    right side has one row per node, so a hub is no hot group, and that side grows with the graph, so it is merged and
    never broadcast. Rounds are cut by written tables.
    """
    edges = materialise(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    labels: DataFrame | None = None
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        parent = materialise(
            both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("node"), F.least("a", "low").alias("up")),
            "parents",
        )
        for _ in range(2):
            above = parent.select(F.col("node").alias("up"), F.col("up").alias("top"))
            parent = parent.join(above.hint("merge"), "up").select("node", F.col("top").alias("up"))
        parent = materialise(parent, "pointers")
        if labels is None:
            labels = parent.select("node", F.col("up").alias("component"))
        else:
            moved = parent.withColumnRenamed("node", "component")
            labels = materialise(
                labels.join(moved.hint("merge"), "component", "left").select("node", F.coalesce("up", "component").alias("component")),
                "labels",
            )
        ends = edges
        for side in ("a", "b"):
            root = parent.select(F.col("node").alias(side), F.col("up").alias(f"r{side}"))
            ends = ends.join(root.hint("merge"), side)
        ends = ends.where("ra <> rb")
        edges = materialise(
            ends.select(F.greatest("ra", "rb").alias("a"), F.least("ra", "rb").alias("b")).distinct(), "edges"
        )
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels
