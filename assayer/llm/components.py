"""Connected components of an edge table by joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.session import settle


def connected(edges: DataFrame) -> DataFrame:
    """``node, label``: the least node reachable, for every node of ``edges (a, b)``.

    Each round takes the least label among neighbours, then the label's own label, so long chains
    shorten by halves. Ends when a round changes nothing. No edges give no rows.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = settle(both.where("a <> b").distinct(), "edges")
    labels = settle(both.groupBy("a").agg(F.least("a", F.min("b")).alias("label")), "labels")
    labels = labels.withColumnRenamed("a", "node")
    while True:
        reach = both.join(labels.select(F.col("node").alias("b"), "label"), "b")
        near = reach.groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        stepped = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("next"))
        above = labels.select(F.col("node").alias("next"), F.col("label").alias("top"))
        moved = settle(
            stepped.join(above, "next", "left").select("node", "label", F.least("next", "top").alias("to")),
            "labels",
        )
        changed = not moved.where("to < label").isEmpty()
        labels = moved.select("node", F.col("to").alias("label"))
        if not changed:
            return labels
