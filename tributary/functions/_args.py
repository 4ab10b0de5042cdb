from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrExpr = Column | str


def as_column(value: ColumnOrExpr) -> Column:
    """A column as it is; text is read as a SQL expression, so a bare name works too."""
    return value if isinstance(value, Column) else F.expr(value)


def as_value(value) -> Column:
    """Like ``as_column``, but numbers, dates and other Python values become literals."""
    return as_column(value) if isinstance(value, Column | str) else F.lit(value)


def sql_text(value) -> str:
    """A value as a SQL string literal."""
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_list(values) -> str:
    """Text values as a comma-separated list of literals; ``None`` becomes NULL."""
    return ", ".join("null" if value is None else sql_text(value) for value in values)
