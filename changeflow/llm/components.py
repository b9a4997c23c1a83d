"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import cut_lineage


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges (a, b)``; the root is the smallest node of the component.

    Every round takes the smallest label of the neighbours, then the label of that label, so labels travel in doubling
    steps. Labels stay on the executors (merge joins: nothing is broadcast through the driver) and are cut reliably in each round.
    """
    both = cut_lineage(edges.select("a", "b").union(edges.select("b", "a")).distinct())
    labels = cut_lineage(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root")).select("node", F.least("node", "root").alias("root")))
    while True:
        around = (
            both.join(labels.select(F.col("node").alias("b"), "root").hint("merge"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("around"))
        )
        lower = cut_lineage(labels.join(around.hint("merge"), "node").select("node", "root", F.least("root", "around").alias("next")))
        up = lower.select(F.col("node").alias("next"), F.col("next").alias("up"))
        jumped = cut_lineage(lower.join(up.hint("merge"), "next").select("node", "root", F.least("next", "up").alias("next")))
        moved = not jumped.filter(F.col("next") < F.col("root")).isEmpty()
        labels = jumped.select("node", F.col("next").alias("root"))
        if not moved:
            return labels


def joined_components(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """``labels`` after further ``edges``: only edges between different components are followed, on their roots."""
    roots = edges
    for end in ("a", "b"):
        of = labels.select(F.col("node").alias(end), F.col("root").alias(f"r_{end}"))
        roots = roots.join(of.hint("merge"), end, "left").withColumn(f"r_{end}", F.coalesce(f"r_{end}", end))
    above = connected_components(roots.select(F.col("r_a").alias("a"), F.col("r_b").alias("b")).filter("a != b"))
    up = above.select(F.col("node").alias("root"), F.col("root").alias("up"))
    known = labels.join(up.hint("merge"), "root", "left").select("node", F.coalesce("up", "root").alias("root"))
    # nodes that had no link before are roots of their own
    return cut_lineage(known.union(above.join(labels.select("node").hint("merge"), "node", "left_anti").select("node", "root")))
