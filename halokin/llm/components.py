"""Connected components of an edge table by minimum labels and pointer jumping.

Every round is a few joins over written tables; what reaches the driver is one
number, the count of labels that changed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, label): label is the smallest node of the component, for all nodes of ``edges`` (columns a, b)."""
    both = materialize(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), "cc-edges")
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                         .select("node", F.least("node", "m").alias("label")), "cc-labels")
    while True:
        near = (both.join(labels.select(F.col("node").alias("b"), "label"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near")))
        low = labels.join(near, "node").select("node", F.least("label", "near").alias("label"), F.col("label").alias("old"))
        low = materialize(low, "cc-low")
        jump = low.select(F.col("node").alias("label"), F.col("label").alias("to"))
        new = materialize(low.join(jump, "label").select("node", F.col("to").alias("label"), (F.col("to") != F.col("old")).alias("changed")),
                          "cc-labels")
        changed = new.where("changed").count()
        labels = new.select("node", "label")
        if not changed:
            return labels
