"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickertide.session import cut_lineage


def components(links: DataFrame) -> DataFrame:
    """(node, label) for links (a, b): the smallest node of its component for each node.

    Each round a node takes the smallest label among its own, its neighbours' and its
    label's, so labels cross paths in steps that grow. Each round ends in a checkpoint. Sums
    over a node's links are combined before they are shuffled, so a node with very many
    links is no problem.
    """
    both = cut_lineage(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut_lineage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("label")))
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("near"))
        step = labels.join(near, labels["node"] == near["a"]).select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        step = cut_lineage(step.join(jump, "label").select("node", "old", F.least("label", "next").alias("label")))
        changed = step.where(F.col("old") != F.col("label")).isEmpty()
        labels = step.select("node", "label")
        if changed:
            return labels
