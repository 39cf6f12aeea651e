"""Connected components of a graph of long-valued nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstrata.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); ``root`` is the smallest node reachable.

    Every round takes the smallest label among the neighbours and then follows the label of that
    label, so long chains shrink quickly. A round is written to the shared folder, which keeps
    the plan short and survives lost executors. Joins are between stored tables on one side with
    unique keys, so that the skew-join rule can split a popular label.
    """
    both = stored(
        edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        .where("a <> b").distinct()
    )
    labels = stored(
        both.groupBy("a").agg(F.min("b").alias("m"))
        .select(F.col("a").alias("node"), F.least("a", "m").alias("root"))
    )
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("b"), "root"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("root").alias("m"))
        )
        lower = stored(
            labels.join(near, "node", "left").select(
                "node", F.least("root", "m").alias("root"), (F.col("m") < F.col("root")).alias("moved")
            )
        )
        if not lower.where("moved").limit(1).count():
            return lower.select("node", "root")
        roots = lower.select(F.col("node").alias("root"), F.col("root").alias("above"))
        labels = stored(
            lower.select("node", "root").join(roots, "root", "left")
            .select("node", F.coalesce("above", "root").alias("root"))
        )
