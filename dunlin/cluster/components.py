"""Connected components by contraction, with the lineage cut every round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dunlin.operators.joins import lookup_join
from dunlin.session import materialize


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Rows ``(node, component)``, the component being its smallest node.

    ``edges`` has ``a, b``. In a round every node points to its smallest
    neighbour, pointers are followed, and the edges are rewritten between the
    nodes pointed to, so the graph shrinks by a factor each round.
    """
    low, high = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    edges = materialize(edges.select(low, high).where("a <> b").distinct(), "edges")
    steps = []
    while edges.limit(1).count():
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = both.groupBy("a").agg(F.least("a", F.min("b")).alias("up"))
        for _ in range(2):
            jump = up.select(F.col("a").alias("up"), F.col("up").alias("next"))
            up = up.join(jump, "up").select("a", F.col("next").alias("up"))
        up = materialize(up, "up")
        steps.append(up)
        moved = lookup_join(edges, up, ["a"]).select(F.col("b").alias("a"), F.col("up").alias("x"))
        moved = lookup_join(moved, up, ["a"]).select(F.col("x").alias("a"), F.col("up").alias("b"))
        edges = materialize(moved.select(low, high).where("a <> b").distinct(), "edges")
    found = nodes.select("node", F.col("node").alias("a"))
    for up in steps:
        found = lookup_join(found, up, ["a"], "left").select("node", F.coalesce("up", "a").alias("a"))
    return materialize(found.withColumnRenamed("a", "component"), "components")
