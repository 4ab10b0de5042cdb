"""Column lists taken from a DataFrame's schema."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def quoted(name: str) -> str:
    """A column name as SQL text, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def filtered_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Column names without those listed; letter case does not matter."""
    dropped = {name.lower() for name in exclude}
    return [name for name in df.columns if name.lower() not in dropped]


def star(
    df: DataFrame,
    relation_alias: str | None = None,
    exclude: Iterable[str] = (),
    prefix: str = "",
    suffix: str = "",
) -> list[Column]:
    """All columns but the excluded ones, renamed only if a prefix or suffix is given."""
    table = f"{quoted(relation_alias)}." if relation_alias else ""
    columns = []
    for name in filtered_columns(df, exclude):
        column = F.col(table + quoted(name))
        columns.append(column.alias(prefix + name + suffix) if prefix or suffix else column)
    return columns


def nullcheck(df: DataFrame, columns: Iterable[str] | None = None) -> list[Column]:
    """The named columns (default: all), with empty text turned into NULL."""
    names = list(df.columns if columns is None else columns)
    types = {field.name.lower(): field.dataType for field in df.schema}
    return [
        F.nullif(F.col(quoted(name)), F.lit("")).alias(name)
        if isinstance(types[name.lower()], StringType)
        else F.col(quoted(name))
        for name in names
    ]


def nullcheck_table(df: DataFrame) -> DataFrame:
    """The whole table, with empty text turned into NULL."""
    return df.select(nullcheck(df))


def group_by_first(df: DataFrame, n: int) -> GroupedData:
    """Group by the first ``n`` columns of the table."""
    return df.groupBy(*[F.col(quoted(name)) for name in df.columns[:n]])
