"""Connected components of things that share keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadloom.sources.scratch import written


def components(members: DataFrame) -> DataFrame:
    """``(node, component)`` for ``members (node, key)``: nodes joined by shared keys.

    The component is its smallest node. Each round takes the smallest label over
    every key and every node, then follows the label's own label, so long chains
    shrink quickly. A key with very many nodes is reduced by partial minima and
    never collected. Rounds are written out, so that the plan does not grow and a
    lost executor costs one round.
    """
    shared = members.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    links = written(members.join(shared, "key", "left_semi"), "links")
    labels = links.groupBy("key").agg(F.min("node").alias("low"))
    labels = links.join(labels, "key").groupBy("node").agg(F.min("low").alias("component"))
    labels = written(labels, "labels")
    while not _agree(links, labels):
        low = links.join(labels, "node").groupBy("key").agg(F.min("component").alias("low"))
        near = links.join(low, "key").groupBy("node").agg(F.min("low").alias("near"))
        far = labels.select(F.col("node").alias("near"), F.col("component").alias("far"))
        labels = written(near.join(far, "near").select("node", F.least("near", "far").alias("component")), "labels")
    alone = members.select("node").distinct().join(labels.select("node"), "node", "left_anti")
    return labels.unionByName(alone.withColumn("component", F.col("node")))


def _agree(links: DataFrame, labels: DataFrame) -> bool:
    """Whether the nodes of every key have one label."""
    spread = links.join(labels, "node").groupBy("key").agg(
        F.min("component").alias("low"), F.max("component").alias("high")
    )
    return spread.where("low <> high").isEmpty()
