from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, TimestampNTZType, TimestampType

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, and the SQL it is compared with."""

    def register(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: portable(run(spark, sf_dir))
        if sql is not None:
            ORACLE[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def portable(df: DataFrame) -> DataFrame:
    """Dates and times as text and decimals as doubles, which all engines print alike."""
    printed = {}
    for field in df.schema:
        name = f"`{field.name}`"
        if isinstance(field.dataType, DateType):
            printed[field.name] = F.date_format(name, "yyyy-MM-dd")
        elif isinstance(field.dataType, TimestampType | TimestampNTZType):
            printed[field.name] = F.date_format(name, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(field.dataType, DecimalType):
            printed[field.name] = F.col(name).cast("double")
    return df.withColumns(printed) if printed else df
