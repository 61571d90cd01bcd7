"""Connected components of a table of links, by rounds of joins and minima; nothing is gathered in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import forget, stage


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``component`` for every node of ``edges`` (columns a, b): the smallest node that it is linked with,
    directly or not, itself included.

    Each round gives every node the least label among its neighbours and then the label of that label, so that long
    chains shrink quickly. A node of very many links takes part through partial minima on the one side and through a
    join whose other side has one row for it, which adaptive execution splits, on the other. Every round is a table in
    the shared folder; the rounds end when no label changes.
    """
    both = stage(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
                 .filter("a != b").distinct(), "links")
    labels = held = stage(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
                   .select("node", F.least("node", "least").alias("component")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        step = labels.join(near, "node").select("node", F.col("component").alias("before"), F.least("component", "near").alias("component"))
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("further"))
        after = stage(step.join(jump, "component", "left").select(
            "node", "before", F.least("component", F.coalesce("further", "component")).alias("component")), "labels")
        forget(held)
        held, labels = after, after.select("node", "component")
        if after.filter("before != component").isEmpty():
            forget(both)
            return labels
