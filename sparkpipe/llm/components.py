"""Connected components by label propagation with pointer jumping, all in joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def components(links: DataFrame) -> DataFrame:
    """node, label: the smallest node that each node of ``links`` (a, b) is connected with.

    Each round takes the smallest label among the neighbours and then the label of that
    label, so chains halve; rounds stop when no label changes.  Every round is written to
    the shared folder.
    """
    both = links.select(F.col("a").alias("node"), F.col("b").alias("other")) \
        .unionByName(links.select(F.col("b").alias("node"), F.col("a").alias("other")))
    both = materialise(both.distinct(), "links")
    labels = materialise(both.groupBy("node").agg(F.least("node", F.min("other")).alias("label")), "labels")
    while True:
        seen = labels.select(F.col("node").alias("other"), F.col("label").alias("theirs"))
        near = both.join(seen, "other").groupBy("node").agg(F.min("theirs").alias("near"))
        new = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("to"))
        jump = labels.select(F.col("node").alias("to"), F.col("label").alias("beyond"))
        new = materialise(new.join(jump, "to", "left").select(
            "node", "old", F.least("to", F.coalesce("beyond", "to")).alias("label")), "labels")
        labels = new.select("node", "label")
        if new.where("label != old").isEmpty():
            return labels
