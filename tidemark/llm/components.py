"""Connected components of a table of links, by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import drop, stage


def components(links: DataFrame) -> DataFrame:
    """Columns (node, label) for every node that a row (a, b) of ``links`` names; label is the
    smallest node of its component.

    Each round a node takes the smallest label among its neighbours' and its own,
    then the label of that label: rounds grow with the logarithm of a component's
    length.  Labels stay in the shared folder; the driver sees only a count.
    """
    spark = links.sparkSession
    edges = stage(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
                  .where("a != b").distinct(), "links")
    labels = stage(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                   .select("node", F.least("node", "m").alias("label")), "labels")
    while True:
        near = (edges.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node"))
                .agg(F.min("label").alias("near")))
        stepped = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("low"))
        jumped = (stepped.join(labels.select(F.col("node").alias("low"), F.col("label").alias("far")), "low")
                  .select("node", F.least("low", "far").alias("new"), "label"))
        done = stage(jumped.select("node", F.col("new").alias("label"), (F.col("new") != F.col("label")).alias("moved")),
                     "labels")
        moved = done.where("moved").limit(1).count()
        drop(spark, labels)
        labels = done.drop("moved")
        if not moved:
            return labels
