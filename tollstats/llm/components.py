"""Connected components by spreading the smallest id, in joins that halve the distances."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollstats.llm.staging import checkpointed


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in ``links`` (a, b); the component is its smallest node.

    Each round takes the smallest label among a node and its neighbours, then
    the label of that label. It ends when a round changes nothing, which takes
    about the logarithm of the longest path. A node with any number of links
    sends one label per map task.
    """
    both = checkpointed(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    labels = checkpointed(
        both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("component"))
    )
    while True:
        offered = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("offered"))
        )
        lower = labels.join(offered, "node").select(
            "node", F.col("component").alias("before"), F.least("component", "offered").alias("component")
        )
        roots = labels.select(F.col("node").alias("component"), F.col("component").alias("root"))
        new = checkpointed(
            lower.join(roots, "component").select("node", "before", F.least("component", "root").alias("component"))
        )
        labels = new.select("node", "component")
        if new.where(F.col("before") != F.col("component")).isEmpty():
            return labels
