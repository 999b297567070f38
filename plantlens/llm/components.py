"""Connected components by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import written


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for each node of ``edges`` (a, b): label is the component's least node.

    Each round takes the least label of the neighbours and then the label's
    own label, so a path of n nodes takes about log n rounds.  Partial minima
    keep a node with very many neighbours from meeting in one task.  Loops and
    repeated edges are allowed; no edges give no rows.
    """
    both = written(
        edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        "component-edges")
    labels = written(
        both.groupBy("a").agg(F.min("b").alias("least"))
        .select(F.col("a").alias("node"), F.least("a", "least").alias("label")), "component-labels")
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("b"), "label"), "b")
            .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near")))
        moved = labels.join(near, "node").select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        moved = written(moved, "component-labels")
        jumped = moved.join(
            moved.select(F.col("node").alias("label"), F.col("label").alias("further")), "label", "left"
        ).select("node", "old", F.least("label", F.coalesce("further", "label")).alias("label"))
        labels = written(jumped, "component-labels")
        if labels.where("label <> old").isEmpty():
            return labels.select("node", "label")
        labels = labels.select("node", "label")
