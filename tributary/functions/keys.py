"""Hashed keys over several columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tributary.functions._args import ColumnOrExpr, as_column, sql_text

# Keys made elsewhere only match if these texts are the same.
NULL_TEXT = "_dbt_utils_surrogate_key_null_"
SEPARATOR = "-"


def surrogate_key_sql(columns: Sequence[str], nulls_as_empty: bool = False) -> str:
    """SQL text of ``surrogate_key``, for models that are views too."""
    missing = sql_text("" if nulls_as_empty else NULL_TEXT)
    parts = [f"coalesce(cast({column} as string), {missing})" for column in columns]
    return f"md5(concat_ws({sql_text(SEPARATOR)}, {', '.join(parts)}))"


def surrogate_key(columns: Sequence[ColumnOrExpr], nulls_as_empty: bool = False) -> Column:
    """MD5, in hex, of the joined text of the columns.

    NULL has a text of its own, so it differs from an empty string unless
    ``nulls_as_empty`` is set.
    """
    if isinstance(columns, str | Column):
        raise TypeError("pass a list of columns, not a single column")
    if all(isinstance(column, str) for column in columns):
        return F.expr(surrogate_key_sql(columns, nulls_as_empty))
    missing = F.lit("" if nulls_as_empty else NULL_TEXT)
    parts = [F.coalesce(as_column(column).cast("string"), missing) for column in columns]
    return F.md5(F.concat_ws(SEPARATOR, *parts))


def timestamp_text(moment: ColumnOrExpr) -> Column:
    """A timestamp as key text: UTC, with no, three or six digits after the second.

    Spark's own cast drops single trailing zeros, so its text would give other
    keys than a warehouse that shortens the fraction three digits at a time.
    """
    if isinstance(moment, str):
        return F.expr(timestamp_text_sql(moment))
    text = moment.cast("string")
    length = F.length(text)
    padded = F.when(length == 19, 19).when(length <= 23, 23).otherwise(26)
    return F.concat(F.rpad(text, padded, "0"), F.lit("+00"))


def timestamp_text_sql(moment: str) -> str:
    """SQL text of ``timestamp_text``."""
    text = f"cast({moment} as string)"
    padded = f"case when length({text}) = 19 then 19 when length({text}) <= 23 then 23 else 26 end"
    return f"concat(rpad({text}, {padded}, '0'), '+00')"
