"""A folder every executor can reach, for tables that later steps read."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
# Folders made so far, by the id of the application that made them.
_made: dict[str, list[str]] = {}


def scratch_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, else one inside the warehouse.

    The warehouse is shared by the driver and all executors wherever tables can be
    saved. Where neither is set it would be a folder of the driver's machine, which no
    executor elsewhere can read, so outside local mode that is an error.
    """
    root = spark.conf.get(_SETTING, None)
    if root:
        return root.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    if warehouse.startswith("file:") and not spark.sparkContext.master.startswith("local"):
        raise ValueError(
            f"{_SETTING} is not set and the warehouse, {warehouse}, lies on this machine alone; "
            "name a folder that all executors share"
        )
    return f"{warehouse}/_scratch".rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below ``scratch_root``."""
    path = f"{scratch_root(spark)}/{name}-{uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` from a table written to scratch space.

    For a result that several later queries read: it is computed once, survives the
    loss of executors, and each reader takes only the columns it needs.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> None:
    """Deletes what this application has written below ``scratch_root``.

    Results that still read those tables must have been saved or collected before.
    """
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    for path in _made.pop(spark.sparkContext.applicationId, []):
        place = hadoop.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
