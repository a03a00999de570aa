"""Connected components of an edge table, without bringing links or labels to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.session import discard, stage


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of (a, b): the smallest node that links reach.

    Each round takes the least label of the neighbours, then follows labels to their own labels, so long chains halve
    per round. Every round is staged, and the one before it deleted; only the count of changed labels reaches the driver. A node of very many links
    is the right side of both joins with one row, so its rows split across tasks.
    """
    links = stage(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    least = F.least("a", F.min("b"))
    labels = held = stage(links.groupBy("a").agg(least.alias("component")).withColumnRenamed("a", "node"), "labels")
    while True:
        near = (
            links.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy("a").agg(F.min("component").alias("near")).withColumnRenamed("a", "node")
        )
        nearer = labels.join(near, "node").select("node", F.col("component").alias("was"), F.least("component", "near").alias("at"))
        roots = labels.select(F.col("node").alias("at"), F.col("component").alias("root"))
        after = nearer.join(roots, "at").select("node", F.least("at", "root").alias("component"), "was")
        after = stage(after, "labels")
        discard(held)
        labels, held = after.select("node", "component"), after
        if after.where("component <> was").isEmpty():
            discard(links)
            return labels
