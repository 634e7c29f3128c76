"""Connected components of a table of links, by smallest labels with shortcuts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """One row (node, component) for each end of a link; component is the smallest node reachable.

    Every round takes the smallest label among the neighbours, then the label of that label, so
    the number of rounds grows with the logarithm of the longest path. Minima are combined before
    they are shuffled, and joins on a busy node are plain sort-merge joins that Spark splits.
    Links to itself, repeated links and nulls change nothing; no link gives an empty table.
    """
    pairs = links.select(F.col(left).alias("a"), F.col(right).alias("b")).where("a <> b")
    both = stored(pairs.union(pairs.select("b", "a")).distinct())
    labels = stored(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label")))
    while True:
        near = (both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("label").alias("m"))
                .withColumnRenamed("a", "node"))
        lower = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "m").alias("label"))
        # The label is itself a node; take over its label.
        beyond = labels.select(F.col("node").alias("label"), F.col("label").alias("beyond"))
        new = stored(lower.join(beyond, "label", "left").select(
            "node", "old", F.least("label", F.coalesce("beyond", "label")).alias("label")))
        labels = new.select("node", "label")
        if new.where("old <> label").isEmpty():
            return labels.withColumnRenamed("label", "component")
