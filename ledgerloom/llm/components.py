"""Connected components of a link table, by labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import cut_lineage


def connected(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): root is the smallest node reachable.

    Each round takes the smallest label among a node and its neighbours, then
    the label of that label, so chains shorten by a factor a round. Rounds are
    stored in the shared folder. No row is collected.
    """
    both = cut_lineage(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut_lineage(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("root")).withColumnRenamed("a", "node"))
    while True:
        near = (
            both.join(labels, F.col("b") == F.col("node"))
            .groupBy("a")
            .agg(F.min("root").alias("near"))
            .join(labels, F.col("a") == F.col("node"))
            .select("node", F.col("root").alias("was"), F.least("root", "near").alias("root"))
        )
        jump = labels.select(F.col("node").alias("at"), F.col("root").alias("beyond"))
        jumped = near.join(jump, F.col("root") == F.col("at")).select("node", "was", F.least("root", "beyond").alias("root"))
        stored = cut_lineage(jumped)
        labels = stored.select("node", "root")
        if stored.filter(F.col("root") != F.col("was")).isEmpty():
            return labels
