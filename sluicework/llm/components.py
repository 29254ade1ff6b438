"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicework.sources.scratch import written_out


def connected_components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``node``, ``component``: the smallest node that links ``a``, ``b`` lead to.

    Each step takes the smallest label among the neighbours and then the label's own
    label, so a chain of n links needs about log n steps. A step is a written table;
    lost executors repeat no earlier one.
    """
    both = written_out(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    labels = written_out(nodes.select("node", F.col("node").alias("component")))
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("b"), "component"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("near"))
        )
        lowered = labels.join(near, "node", "left").select(
            "node", F.col("component").alias("before"), F.least("component", F.coalesce("near", "component")).alias("component")
        )
        jumps = labels.select(F.col("node").alias("component"), F.col("component").alias("beyond"))
        after = written_out(
            lowered.join(jumps, "component").select("node", "before", F.least("component", "beyond").alias("component"))
        )
        labels = after.select("node", "component")
        if after.filter("component <> before").isEmpty():
            return labels
