"""Connected components of an edge table by smallest label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import stage_table


def components(edges: DataFrame) -> DataFrame:
    """Smallest node reachable from every node: (node, root).

    ``edges`` has columns a and b (long).  Each round a node takes the smallest
    label among its neighbours, then the label of its label, so chains shorten
    by half; rounds are stage tables, and only a count of changes comes to the
    driver.  Nodes without edges are not listed."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stage_table(both.where(F.col("a") != F.col("b")).distinct(), "edges")
    labels = stage_table(both.groupBy(F.col("a").alias("node")).agg(
        F.min(F.least("a", "b")).alias("root")), "labels")
    while True:
        near = (both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("root").alias("near")))
        nearer = labels.join(near, F.col("node") == F.col("a")).select(
            "node", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        nearer = stage_table(nearer, "labels")
        of = nearer.select(F.col("node").alias("via"), F.col("root").alias("far"))
        jumped = stage_table(nearer.join(of, F.col("root") == F.col("via")).select(
            "node", "old", F.least("root", "far").alias("root")), "labels")
        labels = jumped.select("node", "root")
        if jumped.where(F.col("old") != F.col("root")).limit(1).count() == 0:
            return labels
