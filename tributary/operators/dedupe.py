"""First row of each group."""

from __future__ import annotations

from pyspark.sql import DataFrame


def deduplicate(df: DataFrame, partition_by: str, order_by: str) -> DataFrame:
    """One row for each ``partition_by``: the first by ``order_by`` (both SQL text).

    Spark keeps only the best row of each group in every input task before the
    shuffle (``WindowGroupLimit``), so a group of any size reaches its reducer as
    at most one row for each task.
    """
    rank = f"row_number() over (partition by {partition_by} order by {order_by}) as __rank"
    return df.selectExpr("*", rank).where("__rank = 1").drop("__rank")
