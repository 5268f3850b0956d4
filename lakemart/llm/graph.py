"""Connected components by the least label, as joins over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node in ``links`` (a, b): the least node it can be reached from.

    Each round takes the least label among the neighbours, then the label of
    that label, so long chains shrink by half a round.
    """
    both = stored(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = stored(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")).select(F.col("a").alias("node"), "label"), "labels")
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("b"), "label"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        # The least label around may itself have moved on.
        further = labels.select(F.col("node").alias("near"), F.col("label").alias("far"))
        moved = stored(
            labels.join(near, "node")
            .withColumn("near", F.least("label", "near"))
            .join(further, "near", "left")
            .select("node", F.least("near", F.coalesce("far", "near")).alias("label"), (F.least("near", F.coalesce("far", "near")) != F.col("label")).alias("new")),
            "labels",
        )
        labels = moved.select("node", "label")
        if moved.where("new").isEmpty():
            return labels
