"""Connected components over an edge table, in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm.common import reliable


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b: long); the label is the
    smallest node of its component. Smallest labels travel along the edges, and
    each round also jumps to the label's own label, so long chains take few
    rounds. Each round is checkpointed; nothing but a count reaches the driver."""
    both = reliable(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct())
    labels = reliable(both.groupBy("a").agg(F.min("b").alias("m"))
                      .select(F.col("a").alias("node"), F.least("a", "m").alias("label")))
    while True:
        near = (both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("m")))
        step = (labels.join(near, labels.node == near.a)
                .select("node", F.col("label").alias("old"), F.least("label", "m").alias("label")))
        jump = labels.select(F.col("node").alias("via"), F.col("label").alias("far"))
        step = reliable(step.join(jump, step.label == jump.via)
                        .select("node", "old", F.least("label", "far").alias("label")))
        moved = step.where("old <> label").limit(1).count()
        labels = step.select("node", "label")
        if not moved:
            return labels
