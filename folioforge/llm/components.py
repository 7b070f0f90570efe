"""Connected components of an edge table, by contraction.

In each round every node points at the least node of its closed neighbourhood.
Pointers are followed to their roots by doubling (a table of pointers joined with
itself until none moves), and edges between the roots are the next, smaller graph.
A root of two nodes or more at least halves them, and a root that stands alone has
a smaller root beside it, so nodes halve every second round; doubling takes the
logarithm of the longest chain of pointers. The least node of a component never
moves, so its label is the component's least.

Nothing but "is there a row" reaches the driver; each step is written as a table,
and joins are between written tables, so that AQE can split a hot root.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.llm.common import materialize


def roots(moves: DataFrame, steps: list | None = None) -> DataFrame:
    """(node, to) with each pointer followed to the node that points at itself."""
    while True:
        here, there = moves.toDF("node", "mid"), moves.toDF("mid_node", "end")
        followed = here.join(there, here["mid"] == there["mid_node"], "left").select(
            "node", F.coalesce("end", "mid").alias("to"), (F.coalesce("end", "mid") != F.col("mid")).alias("moved"))
        followed = materialize(followed, "pointers")
        if steps is not None:
            steps.append("pointers")
        moves = followed.select("node", "to")
        if followed.where("moved").isEmpty():
            return moves


def components(edges: DataFrame, steps: list | None = None) -> DataFrame:
    """(node, label) of all nodes of ``edges`` (a, b); label is the least node
    reachable. ``steps``, if given, gets an entry for each written table of pointers."""
    edges = materialize(edges.select("a", "b").where("a <> b").distinct(), "edges")
    labels = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        moves = materialize(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("to")).select(
            "node", F.least("node", "to").alias("to")), "moves")
        if steps is not None:
            steps.append("moves")
        moves = roots(moves, steps)
        if labels is None:
            labels = moves.withColumnRenamed("to", "label")
        else:
            labels = materialize(labels.join(moves, labels["label"] == moves["node"], "left").select(
                labels["node"], F.coalesce("to", "label").alias("label")), "labels")
        a, b = moves.toDF("a", "ta"), moves.toDF("b", "tb")
        edges = materialize(edges.join(a, "a").join(b, "b").where("ta <> tb").select(
            F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).distinct(), "edges")
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels
