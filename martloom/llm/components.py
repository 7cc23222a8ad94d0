"""Connected components of links between ids, kept in tables from end to end."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.session import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable over ``links`` (a, b).

    Each round takes the smallest label of the neighbours and then the label of that label,
    so paths halve; rounds grow with the logarithm of the longest path. Every round is a
    written table: lineage stays short and a lost executor costs one round at most. An empty
    table gives an empty table. A node with many neighbours is met by a partial minimum.
    """
    both = materialize(links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct(), "links")
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label")), "labels")
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("b"), "label"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        low = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("low"))
        up = labels.select(F.col("node").alias("low"), F.col("label").alias("up"))
        step = materialize(low.join(up, "low").select("node", "old", F.least("low", "up").alias("label")), "labels")
        labels = step.select("node", "label")
        if step.where(F.col("old") != F.col("label")).isEmpty():
            return labels
