"""Rules about single rows. An unknown (NULL) comparison passes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.checks.violations import RowCounts, RowViolations, Violations, subset
from tributary.functions._args import as_column, as_value
from tributary.operators.columns import quoted


def _row_rule(df: DataFrame, broken: Column, where: str | None, *shown: Column) -> RowViolations:
    return RowViolations(df, F.expr(where) & broken if where else broken, shown)


def not_null(df: DataFrame, column: str, where: str | None = None) -> RowViolations:
    """The value is NULL."""
    return _row_rule(df, as_column(column).isNull(), where)


def accepted_range(
    df: DataFrame,
    column: str,
    min_value=None,
    max_value=None,
    inclusive: bool = True,
    where: str | None = None,
) -> RowViolations:
    """The value lies outside the range; a bound left out is open."""
    value, broken = as_column(column), F.lit(False)
    if min_value is not None:
        low = as_value(min_value)
        broken = broken | ~(value >= low if inclusive else value > low)
    if max_value is not None:
        high = as_value(max_value)
        broken = broken | ~(value <= high if inclusive else value < high)
    return _row_rule(df, broken, where)


def expression_is_true(
    df: DataFrame, expression: str, column: str | None = None, where: str | None = None
) -> RowViolations:
    """The SQL condition is false; with ``column`` the condition continues that column's name."""
    condition = f"{column} {expression}" if column else expression
    return _row_rule(df, ~F.expr(condition), where)


def assert_equal(
    df: DataFrame, actual: str, expected: str, where: str | None = None
) -> RowViolations:
    """Two columns of a row differ."""
    return _row_rule(df, as_column(actual) != as_column(expected), where)


def not_empty_string(
    df: DataFrame, column: str, trim_whitespace: bool = True, where: str | None = None
) -> RowViolations:
    """The text is empty, by default after trimming spaces; the rows show the text only."""
    text = F.col(quoted(column))
    text = F.trim(text) if trim_whitespace else text
    return _row_rule(df, text == "", where, text.alias(column))


def funnel_order(facts: DataFrame, where: str | None = None) -> Violations:
    """A session skipped the stage before a late one, or sold for a negative amount.

    One row for each session and broken rule, from a single pass over the sessions.
    """
    rules = {
        "checkout_without_cart": "had_begin_checkout and not had_add_to_cart",
        "payment_without_checkout": "had_add_payment_info and not had_begin_checkout",
        "purchase_without_payment": "had_purchase and not had_add_payment_info",
        "negative_revenue_on_purchase": "had_purchase and session_revenue < 0",
    }
    broken = ", ".join(f"if({rule}, '{name}', null)" for name, rule in rules.items())
    return RowCounts(
        subset(facts, where).selectExpr(
            "session_id", f"explode(array_compact(array({broken}))) as violation_type"
        ),
        table=None if where else facts,
        per_row=F.expr(f"size(array_compact(array({broken})))"),
    )
