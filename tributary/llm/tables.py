"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from operator import and_

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tributary.sources.scratch import stored

__all__ = [
    "as_rows", "batches", "each_row", "from_rows", "pick", "place", "read", "sampled",
    "skew_join", "stored",
]

# Keys with more than one in so many rows are dealt over so many slices.
_SHARE, _SLICES = 512, 64


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, **types: str) -> DataFrame:
    """The named columns alone, with these types; columns beside them cannot clash, not even
    with names that differ in letter case only."""
    plain = numbered(df)
    return plain.select(
        *[plain[place(df, name)].cast(kind).alias(name) for name, kind in types.items()]
    )


def numbered(df: DataFrame) -> DataFrame:
    """The same rows under the column names c0, c1, ..."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def place(df: DataFrame, name: str) -> str:
    """The column's name in ``numbered``; an exact match goes before one in other letter case."""
    names = df.columns
    if name not in names:
        names = [own.lower() for own in names]
        name = name.lower()
    return f"c{names.index(name)}"


def as_rows(df: DataFrame) -> DataFrame:
    """All columns as one, ``row``, with the members of ``numbered``; see ``from_rows``."""
    plain = numbered(df)
    return plain.select(F.struct(*plain.columns).alias("row"))


def from_rows(rows: DataFrame, like: DataFrame) -> DataFrame:
    return rows.select("row.*").toDF(*like.columns)


def batches(
    df: DataFrame,
    work: Callable[[pa.RecordBatch], pa.RecordBatch | None],
    schema: str | StructType,
) -> DataFrame:
    """``work`` on each Arrow batch, a slice of a partition at a time."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            out = work(part)
            if out is not None and out.num_rows:
                yield out

    return df.mapInArrow(run, schema)



def sampled(df: DataFrame, by: Column, rows: int) -> DataFrame:
    """At most ``rows`` rows, those with the smallest ``by``, a hash.

    Rows whose hash is far too large to be among them are dropped first, so that no more
    than some times ``rows`` meet in one place, however many tasks there are.
    """
    share = min(1.0, 2 * (rows + 50) / max(df.count(), 1))
    last = min(int(-(2**63) + share * 2**64), 2**63 - 1)
    place = df.withColumn("__by", by).where(F.col("__by") <= last)
    return place.orderBy("__by", *df.columns).limit(rows).drop("__by")


def skew_join(
    rows: DataFrame, small: DataFrame, on: str | list[str], counts: DataFrame | None = None
) -> DataFrame:
    """``rows`` with the columns of ``small``, which has one row a key; null where there is none.

    A key that holds more than one in 512 of all rows is dealt over 64 slices, with a copy
    of its row of ``small`` in each; there are fewer than 512 such keys whatever the input,
    and only these are broadcast. Rows without a key are dealt over the slices too.
    ``counts`` has the keys with the number of their rows, ``n``; without it ``rows``, which
    should be a stored table then, is counted first. The order of ``rows`` within tasks must
    not change from run to run.
    """
    keys = [on] if isinstance(on, str) else on
    if counts is None:
        counts = stored(rows.groupBy(*keys).agg(F.count("*").alias("n")), "keys")
    full = reduce(and_, (F.col(key).isNotNull() for key in keys))
    counts = counts.where(full).groupBy(*keys).agg(F.sum("n").alias("n"))
    limit = (counts.agg(F.sum("n")).first()[0] or 0) / _SHARE
    large = F.broadcast(counts.where(F.col("n") > limit).select(*keys, F.lit(True).alias("__large")))
    dealt = F.col("__large").isNotNull() | ~full
    line = F.monotonically_increasing_id()
    left = rows.withColumn("__line", line).join(large, keys, "left")
    left = left.withColumn("__slice", F.when(dealt, F.col("__line") % _SLICES).otherwise(0))
    last = F.when(F.col("__large"), _SLICES - 1).otherwise(0).cast("bigint")
    right = small.join(large, keys, "left").withColumn(
        "__slice", F.explode(F.sequence(F.lit(0).cast("bigint"), last))
    )
    return left.drop("__line", "__large").join(
        right.drop("__large"), [*keys, "__slice"], "left"
    ).drop("__slice")


def each_row(
    df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch]
) -> DataFrame:
    """``work`` on batches with all columns of ``df``, which must keep those columns.

    Columns go by place in between, so names with dots or odd letters do no harm.
    """
    names = df.columns
    plain = numbered(df)
    own = plain.columns

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        out = work(pa.RecordBatch.from_arrays(part.columns, names))
        return pa.RecordBatch.from_arrays(out.columns, own)

    return batches(plain, run, plain.schema).toDF(*names)
