"""Connected components of links, by least labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable


def components(links: DataFrame) -> DataFrame:
    """``links`` has a and b; returns node and label, the smallest node reachable, for every node with a link.

    Each round takes the least label among neighbours and then the label of that label, so chains shrink by more than
    half a round; every round is kept in the checkpoint folder.
    """
    edges = durable(links.select("a", "b").union(links.select("b", "a")).filter("a <> b").distinct())
    labels = durable(edges.groupBy(F.col("a").alias("node")).agg(F.least("a", F.min("b")).alias("label")))
    while True:
        near = (
            edges.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("near"))
        )
        lower = labels.join(near, F.col("node") == F.col("a")).select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label")
        )
        to = labels.select(F.col("node").alias("via"), F.col("label").alias("jump"))
        labels = durable(
            lower.join(to, F.col("label") == F.col("via")).select("node", "old", F.least("label", "jump").alias("label"))
        )
        if labels.filter("label < old").limit(1).count() == 0:
            return labels.select("node", "label")
        labels = labels.select("node", "label")
