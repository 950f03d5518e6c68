"""Connected components of an edge table, by smallest labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from journey.llm.common import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, comp) for every node of ``edges`` (a, b): comp is the smallest node reachable.

    Each round a node takes the smallest label among itself and its neighbours,
    then that label's label.  Labels only fall, so the loop ends when a round
    changes none; each round's labels are written to the shared folder.  Both
    joins are on a node against one row per node, and minima are aggregated
    before the shuffle, so a node with very many edges is no hot group.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stored(both.where("a <> b").distinct(), "cc-edges")
    labels = stored(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("comp")).withColumnRenamed("a", "node"),
                    "cc-labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("comp").alias("low"))
        step = labels.join(near, labels["node"] == near["a"], "left").select(
            "node", "comp", F.least("comp", F.coalesce("low", "comp")).alias("low"))
        jump = labels.select(F.col("node").alias("low"), F.col("comp").alias("far"))
        new = step.join(jump, "low", "left").select(
            "node", F.least("low", F.coalesce("far", "low")).alias("new"), "comp")
        new = stored(new, "cc-labels")
        moved = new.where("new <> comp").limit(1).count()
        labels = new.select("node", F.col("new").alias("comp"))
        if not moved:
            return labels
