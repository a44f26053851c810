"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortwise.llm.store import stage


def components(edges: DataFrame) -> DataFrame:
    """Label every node of ``edges(a, b)`` with its component's smallest node.

    Returns ``(node, label)`` for the nodes that have an edge to another node;
    loops and repeated edges are fine. Each round points every node at the
    smallest of itself and its neighbours and contracts the graph to these
    parents, so stars vanish in one round and paths shrink geometrically. The
    contracted edges and the parents are written each round; no node, edge or
    label passes through the driver. A node with many edges is combined
    map-side, and its parent row joins as the unique side of a skewed join.
    """
    edges = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()
    edges = stage(edges, "cc-edges")
    rounds = []
    while not edges.isEmpty():
        both = edges.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e"))
        parents = stage(
            both.groupBy(F.col("e.a").alias("node")).agg(F.least(F.first("e.a"), F.min("e.b")).alias("label")), "cc-parents"
        )
        rounds.append(parents)
        left, right = parents.toDF("a", "pa"), parents.toDF("b", "pb")
        moved = edges.join(left, "a").join(right, "b")
        edges = stage(
            moved.where("pa <> pb").select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "cc-edges"
        )
    if not rounds:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    labels = rounds[0]
    for parents in rounds[1:]:
        step = parents.toDF("label", "next")
        labels = labels.join(step, "label", "left").select("node", F.coalesce("next", "label").alias("label"))
    return labels
