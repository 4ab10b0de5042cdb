"""Connected components of a graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.tables import stored


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); nodes of one component share a root.

    Each round every node takes the smallest label around it, then the label of that
    label, so labels travel twice as far each time. A round is written out before the
    next, which keeps plans short and survives lost executors; only the number of changed
    labels comes to the driver. Hubs meet in sums with partial results and in joins whose
    large partitions adaptive execution splits.
    """
    links = stored(
        links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct(), "links"
    )
    labels = stored(
        links.select(F.col("a").alias("node")).distinct().withColumn("root", F.col("node")),
        "labels",
    )
    while True:
        around = (
            links.join(labels, links["b"] == labels["node"])
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("root").alias("around"))
        )
        nearer = labels.join(around, "node").select(
            "node", F.col("root").alias("old"), F.least("root", "around").alias("near")
        )
        nearer = stored(nearer, "nearer")
        if nearer.where("near != old").isEmpty():
            return labels
        target = nearer.select(F.col("node").alias("near"), F.col("near").alias("root"))
        labels = stored(nearer.join(target, "near").select("node", "root"), "labels")
