"""Connected components of an edge list, as iterated joins."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, label) for each node of ``edges(a, b)``; label is the smallest node of the component.

    Each round a node takes the smallest label among itself and its neighbours, then the label of
    its label (pointer jumping), until no label changes. A round is three equi-joins whose one side
    has a row per node; the minimum is aggregated before its shuffle, so a hub adds one row per task.
    Each round's labels are written to the shared scratch folder. No edges: an empty table.
    """
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).filter("a <> b").distinct(), "edges")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
                    .select("node", F.least("node", "low").alias("label")), "labels")
    while True:
        near = (both.join(labels, both.a == labels.node).groupBy(F.col("b").alias("node"))
                .agg(F.min("label").alias("low")))
        hooked = labels.join(near, "node", "left").select(
            "node", F.col("label").alias("old"), F.least("label", "low").alias("label"))
        above = hooked.select(F.col("node").alias("at"), F.col("label").alias("top"))
        now = stored(hooked.join(above, F.col("label") == F.col("at"), "left")
                     .select("node", "old", F.least("label", "top").alias("label")), "labels")
        labels = now.select("node", "label")
        if now.filter("label <> old").isEmpty():
            return labels
