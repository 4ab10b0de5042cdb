"""Arithmetic that treats NULL and zero the way report queries expect."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, sub

from pyspark.sql import Column
from pyspark.sql import functions as F

from tributary.functions._args import ColumnOrExpr, as_column, as_value


def safe_divide(numerator: ColumnOrExpr, denominator: ColumnOrExpr) -> Column:
    """Quotient, or NULL where the denominator is zero or NULL."""
    return F.try_divide(as_column(numerator), as_column(denominator))


def _null_as_zero(terms: Sequence[ColumnOrExpr]) -> list[Column]:
    if isinstance(terms, str | Column):
        raise TypeError("pass a list of columns, not a single column")
    return [F.coalesce(as_column(term), F.lit(0)) for term in terms]


def safe_add(terms: Sequence[ColumnOrExpr]) -> Column:
    """Sum of the columns of one row, NULL counted as zero."""
    return reduce(add, _null_as_zero(terms))


def safe_subtract(terms: Sequence[ColumnOrExpr]) -> Column:
    """First column minus all the others, NULL counted as zero."""
    return reduce(sub, _null_as_zero(terms))


def width_bucket(expr: ColumnOrExpr, low, high, buckets) -> Column:
    """Number of the equal-width bucket: 0 below ``low``, ``buckets + 1`` from ``high`` on."""
    return F.width_bucket(
        as_column(expr).cast("double"),
        as_value(low).cast("double"),
        as_value(high).cast("double"),
        as_value(buckets).cast("bigint"),
    )


def exact_sum(money: ColumnOrExpr, as_type: str) -> Column:
    """Sum of a floating-point amount that does not depend on the order of the rows.

    Floating-point addition gives other last digits for every order in which
    partial sums meet, so a re-run task could change a report. Adding fixed-point
    numbers of the type ``as_type``, such as ``decimal(29,9)``, is exact; only the final
    total becomes a double again. An amount that the type cannot hold without loss is an error.
    """
    amount = as_column(money).cast("double")
    fixed = amount.try_cast(as_type)
    lost = amount.isNotNull() & ~fixed.cast("double").eqNullSafe(amount)
    message = F.concat(F.lit(f"no exact {as_type}: "), amount.cast("string"))
    return F.sum(F.when(lost, F.raise_error(message)).otherwise(fixed)).cast("double")


def total(money: ColumnOrExpr, as_type: str | None = None) -> Column:
    """The plain sum, or ``exact_sum`` if a fixed-point type is given."""
    return exact_sum(money, as_type) if as_type else F.sum(as_column(money))


def total_sql(money: str, as_type: str | None = None) -> str:
    """SQL text of ``total``, for models that are views too."""
    if not as_type:
        return f"sum({money})"
    amount = f"cast({money} as double)"
    fixed = f"try_cast({amount} as {as_type})"
    lost = f"{amount} is not null and not cast({fixed} as double) <=> {amount}"
    message = f"concat('no exact {as_type}: ', cast({amount} as string))"
    return f"cast(sum(case when {lost} then raise_error({message}) else {fixed} end) as double)"
