"""Small results brought to the driver.

Each of these hands plain Python values to the caller, who says how many rows the
driver may get: more raise an error, and nothing is ever cut short. For anything larger
use the DataFrame itself, or ``column_value_counts``.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession


class ResultTooLarge(ValueError):
    """A result meant for the driver has more rows than allowed there."""


def _collect_all(df: DataFrame, max_rows: int) -> list[Row]:
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ResultTooLarge(f"more than {max_rows} rows; keep this result a DataFrame")
    return rows


def single_value(df: DataFrame, default: Any = None) -> Any:
    """First column of the first row, or ``default`` if there is no row."""
    row = df.head()
    return default if row is None else row[0]


def results_as_dict(df: DataFrame, max_rows: int) -> dict[str, tuple]:
    """Column name to the tuple of its values."""
    rows = _collect_all(df, max_rows)
    return {name: tuple(row[i] for row in rows) for i, name in enumerate(df.columns)}


def column_value_counts(
    df: DataFrame,
    column: str,
    order_by: str = "count(*) desc",
    max_records: int | None = None,
    where: str | None = None,
) -> DataFrame:
    """Distinct values of a column (or expression) in order, as a DataFrame with column ``value``.

    ``order_by`` is SQL text evaluated on the groups. With ``max_records`` Spark
    runs a top-k and does not sort everything.
    """
    # Braces of the given texts are not placeholders.
    column, order_by, where = (
        part and part.replace("{", "{{").replace("}", "}}") for part in (column, order_by, where)
    )
    text = f"select {column} as value from {{relation}}"
    if where:
        text += f" where {where}"
    text += f" group by {column} order by {order_by}"
    if max_records is not None:
        text += f" limit {int(max_records)}"
    return df.sparkSession.sql(text, relation=df)


def column_values(
    table: DataFrame | str,
    column: str,
    max_rows: int,
    order_by: str = "count(*) desc",
    max_records: int | None = None,
    default: list | None = None,
    where: str | None = None,
) -> list:
    """Those values as a Python list, for instance to name the columns of a pivot.

    ``table`` may be the name of a catalog table; if there is none the default is
    returned, or an error raised when no default was given.
    """
    if isinstance(table, str):
        spark = SparkSession.active()
        if not spark.catalog.tableExists(table):
            if default is None:
                raise ValueError(f"table {table} does not exist and no default was given")
            return default
        table = spark.table(table)
    ordered = column_value_counts(table, column, order_by, max_records, where)
    values = [row[0] for row in _collect_all(ordered, max_rows)]
    return values or default or []
