"""Parquet tables whose counts and extremes come from their footers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_V1 = "spark.sql.sources.useV1SourceList"
PUSH_DOWN = "spark.sql.parquet.aggregatePushdown"


def read_footers(spark: SparkSession, *paths: str, schema: StructType | None = None) -> DataFrame:
    """A Parquet table of which plain aggregates are read from footers where that is exact.

    Counts, and least and greatest values of numbers, booleans and dates, over the whole table
    or by partition columns, then open no data page. With a filter on other columns, or for
    times and texts, whose footers may hold shortened values, Spark scans the table as usual.

    It needs the session setting ``PUSH_DOWN``, which ``build_session`` makes, and the table
    is planned by the newer of Spark's two Parquet readers, which alone knows it.
    """
    before = spark.conf.get(_V1)
    others = [name for name in before.split(",") if name.strip().lower() != "parquet"]
    spark.conf.set(_V1, ",".join(others))
    try:
        reader = spark.read.schema(schema) if schema else spark.read
        return reader.format("parquet").load(list(paths))
    finally:
        spark.conf.set(_V1, before)
