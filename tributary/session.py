"""Session settings the plans in this package rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Dates and text forms of timestamps follow the session time zone, so it is pinned.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.filterPushdown": "true",
    # Only for tables read with ``sources.read_footers``; others are planned without it.
    "spark.sql.parquet.aggregatePushdown": "true",
    "spark.sql.optimizer.nestedSchemaPruning.enabled": "true",
}


def build_session(
    app_name: str = "tributary",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the settings above; ``conf`` adds to or overrides them.

    ``shuffle_partitions`` is the number of partitions before adaptive execution
    merges small ones. On a cluster choose it so that the shuffled bytes divided
    by it stay near the advisory size: 10 TB of shuffled rows want about 80,000.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(conf or {})}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()
