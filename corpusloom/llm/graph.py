"""Connected components of a graph that is too large for one machine, by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from corpusloom.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """Smallest reachable node for every node of ``edges`` (``x``, ``y``: long). Columns ``node``, ``component``.

    Each round takes the smallest label of a node's neighbours and then the label of that label. Both stay within the
    component and fall, and the rounds end when none falls any more. Stores one narrow table per round. A label that many
    nodes share is looked up by joins that split it.
    """
    both = stored(edges.where("x <> y").select("x", "y").unionByName(edges.where("x <> y").select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct())
    labels = stored(both.groupBy(F.col("x").alias("node")).agg(F.least(F.min("y"), F.col("x")).alias("component")))
    while True:
        near = both.join(labels.withColumnRenamed("node", "y"), "y").groupBy(F.col("x").alias("node")).agg(F.min("component").alias("_near"))
        lower = labels.join(near, "node").select("node", F.least("component", "_near").alias("_low"), F.col("component").alias("_was"))
        root = labels.select(F.col("node").alias("_low"), F.col("component").alias("_root"))
        new = stored(lower.join(root, "_low", "left").select("node", F.least("_low", F.coalesce("_root", "_low")).alias("component"), "_was"))
        labels = new.select("node", "component")
        if new.where(F.col("component") < F.col("_was")).isEmpty():
            return labels
