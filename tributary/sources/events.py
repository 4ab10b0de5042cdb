"""Raw web event records: nested rows, kept by day."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from tributary.operators.columns import quoted
from tributary.operators.reshape import union_all
from tributary.sources.catalog import Described, described_tables
from tributary.sources.versions import folder_names

# Only the members that are read: Parquet then skips the rest of the wide records.
EVENT_SCHEMA = """
    event_date string,
    event_timestamp bigint,
    event_name string,
    user_pseudo_id string,
    event_params array<struct<
        key: string,
        value: struct<string_value: string, int_value: bigint>>>,
    traffic_source struct<medium: string, source: string, name: string>,
    device struct<category: string, operating_system: string>,
    geo struct<country: string>,
    ecommerce struct<
        transaction_id: string, purchase_revenue: double, tax_value: double,
        shipping_value: double>,
    items array<struct<item_id: string>>
"""


_FOLDER = "_day"
_DAY = re.compile(r"\d{8}")


def read_events(spark: SparkSession, path: str, start: str, end: str) -> DataFrame:
    """Event records of a date range from a Parquet folder partitioned by ``event_date``.

    Days are written ``YYYYMMDD``, both ends belong to the range. It is a filter on the
    bare partition column, so other days are not listed or read.
    """
    events = spark.read.schema(EVENT_SCHEMA).parquet(path)
    return events.where(F.col("event_date").between(start, end))


def _conform(value: Column, has: DataType, wants: DataType) -> Column:
    """``value`` with the members of ``wants``; NULL for those it lacks, the rest left out."""
    if isinstance(wants, StructType) and isinstance(has, StructType):
        present = {field.name.lower(): field for field in has}
        members = [
            _conform(
                value[present[field.name.lower()].name],
                present[field.name.lower()].dataType,
                field.dataType,
            )
            if field.name.lower() in present
            else F.lit(None).cast(field.dataType)
            for field in wants
        ]
        named = F.struct(*[m.alias(f.name) for m, f in zip(members, wants, strict=True)])
        return F.when(value.isNotNull(), named)
    if isinstance(wants, ArrayType) and isinstance(has, ArrayType):
        if has.elementType.simpleString() == wants.elementType.simpleString():
            return value
        return F.transform(value, lambda x: _conform(x, has.elementType, wants.elementType))
    return value.cast(wants)


def conform_events(events: DataFrame) -> DataFrame:
    """The columns and members of ``EVENT_SCHEMA``, whatever else a day's records have."""
    wants = StructType.fromDDL(EVENT_SCHEMA)
    present = {field.name.lower(): field for field in events.schema}
    columns = []
    for field in wants:
        own = present.get(field.name.lower())
        value = (
            F.lit(None).cast(field.dataType)
            if own is None
            else _conform(F.col(quoted(own.name)), own.dataType, field.dataType)
        )
        columns.append(value.alias(field.name))
    return events.select(*columns)


def read_event_tables(
    spark: SparkSession, schema: str, start: str, end: str, prefix: str = "events_"
) -> DataFrame:
    """The same from daily catalog tables named prefix + ``YYYYMMDD``.

    Records may gain or lose members from day to day. One listing tells where the tables lie
    and what shape they have; all Parquet tables of one shape become one scan of many
    folders, so thousands of days give as many branches as there are shapes. Views, tables
    in other formats and partitioned ones are a branch each. A table whose records lack
    ``event_date`` gets the day of its name.
    """
    days = [
        table
        for table in described_tables(spark, schema, prefix)
        if table.name.lower().startswith(prefix.lower())
        and start <= table.name[len(prefix) :] <= end
    ]
    if not days:
        raise ValueError(f"no tables {prefix}* in {schema} between {start} and {end}")
    shapes: dict[str, list[Described]] = {}
    for table in days:
        shapes.setdefault(table.shape or table.name, []).append(table)
    return union_all([_one_shape(spark, tables, prefix) for tables in shapes.values()])


def write_event_tables(
    records: DataFrame, schema: str, path: str, prefix: str = "events_"
) -> list[str]:
    """Writes records of one shape as a catalog table for each day, and returns their names.

    One job writes all days below ``path``, a folder that does not exist yet; each day's
    folder is then a table named prefix + ``event_date``. Records without a day are an error,
    found before any table is made, and so is a day that has a table already. No records give
    no tables.
    """
    spark = records.sparkSession
    by_day = records.withColumn(_FOLDER, F.col("event_date"))
    by_day.hint("rebalance", _FOLDER).write.partitionBy(_FOLDER).parquet(path)
    folders = [name for name in folder_names(spark, path) if name.startswith(f"{_FOLDER}=")]
    days = sorted(name.partition("=")[2] for name in folders)
    odd = [day for day in days if not _DAY.fullmatch(day)]
    if odd:
        raise ValueError(f"event_date is no day in some records: {odd[:5]}")
    tables = [f"{quoted(schema)}.{quoted(prefix + day)}" for day in days]
    columns = records.schema.toDDL()
    for table, day in zip(tables, days, strict=True):
        place = f"{path.rstrip('/')}/{_FOLDER}={day}".replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"create table {table} ({columns}) using parquet location '{place}'")
    return [prefix + day for day in days]


def _one_shape(spark: SparkSession, tables: list[Described], prefix: str) -> DataFrame:
    first = tables[0].read(spark)
    dated = any(name.lower() == "event_date" for name in first.columns)
    if dated and tables[0].shape:
        paths = [table.location for table in tables]
        return conform_events(spark.read.schema(first.schema).parquet(*paths))
    if dated:
        return conform_events(first)
    named = [
        table.read(spark).withColumn("event_date", F.lit(table.name[len(prefix) :]))
        for table in tables
    ]
    return union_all([conform_events(table) for table in named])
