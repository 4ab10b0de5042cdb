"""Neighbouring rows in a total order, without putting a whole group into one task."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.operators.columns import quoted

_CHUNK = 10_000


def neighbours(
    df: DataFrame,
    partition_by: Sequence[str],
    order_by: Sequence[str],
    carry: str,
    previous: bool,
    keep: Callable[[Column], Column],
) -> DataFrame:
    """Rows of ``df`` with the ``carry`` value of the next (or previous) row, if ``keep`` says so.

    Rows must be distinct in ``partition_by`` + ``order_by``. The result adds the
    struct column ``neighbour(value)``, NULL at the end of a group; ``keep`` gets
    that column and returns the condition of the rows to return.

    A plain ``lag`` or ``lead`` sorts each group in one task, and the whole table
    if there are no groups. Here the rows are range-partitioned on the full order,
    so tasks are even however the groups are sized, and each slice looks up its
    neighbours on its own. Only the first and last row of each slice lack one; a
    second, tiny window over these edge rows (two for each slice) fills it in.
    """
    keys = [*partition_by, *order_by]
    group = F.struct(F.lit(0).alias("one"), *[F.col(name) for name in partition_by])
    row = F.struct(F.col(carry).alias("value"))
    shift = F.lag if previous else F.lead

    def beside(window) -> Column:
        found = shift(F.struct(group.alias("grp"), row.alias("row"))).over(window)
        return F.when(found["grp"].eqNullSafe(group), found["row"])

    sliced = df.repartitionByRange(*keys).withColumn("__slice", F.spark_partition_id())
    within = Window.partitionBy("__slice").orderBy(*keys)
    first = F.lag(F.lit(1)).over(within).isNull()
    last = F.lead(F.lit(1)).over(within).isNull()
    looked_up = sliced.select(
        "*",
        beside(within).alias("__near"),
        (first | last).alias("__edge"),
        (first if previous else last).alias("__open"),
    )
    unsettled = looked_up.where(F.col("__edge") | keep(F.col("__near")))
    # Edge rows share one group; rows already settled only need to be spread evenly.
    spread = F.when(~F.col("__edge"), F.xxhash64(*keys))
    across = Window.partitionBy("__edge", spread).orderBy(*keys)
    settled = unsettled.select(
        *df.columns,
        F.when(F.col("__open"), beside(across)).otherwise(F.col("__near")).alias("neighbour"),
    )
    return settled.where(keep(F.col("neighbour")))


def repeat_rows(df: DataFrame, copies: str) -> DataFrame:
    """Each row ``copies`` times, without that column.

    Large counts are cut into chunks that are spread over all cores before the rows
    are written out, so one row standing for billions is no single task's work.
    The number of partitions, that of shuffles in this session, is given, because
    chunks are small in bytes and adaptive execution would merge them again.
    """
    n, size = F.col(copies), F.lit(_CHUNK).cast("bigint")
    numbered = df.where(n > 0).withColumn(
        "__chunk", F.explode(F.sequence(F.lit(1).cast("bigint"), F.ceil(n / size)))
    )
    chunks = numbered.withColumn("__size", F.least(size, n - (F.col("__chunk") - 1) * size))
    everything = [F.col(quoted(name)) for name in chunks.columns]
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = chunks.repartition(partitions, *everything)
    one_each = F.sequence(F.lit(1).cast("bigint"), F.col("__size"))
    return spread.withColumn("__copy", F.explode(one_each)).drop(
        copies, "__chunk", "__size", "__copy"
    )
