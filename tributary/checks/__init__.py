"""Data-quality checks.

Each check returns violations: the rows that break a rule, and the metric that
counts them. ``run_checks`` turns a list of named checks into one result table.
"""

from tributary.checks.comparisons import (
    cardinality_equality,
    columns_match_set,
    equal_rowcount,
    equality,
    fewer_rows_than,
    relationships_where,
)
from tributary.checks.groups import (
    accepted_values,
    at_least_one,
    not_accepted_values,
    not_constant,
    not_null_proportion,
    recency,
    unique,
    unique_combination_of_columns,
)
from tributary.checks.report import Check, run_checks
from tributary.checks.rows import (
    accepted_range,
    assert_equal,
    expression_is_true,
    funnel_order,
    not_empty_string,
    not_null,
)
from tributary.checks.sequences import mutually_exclusive_ranges, sequential_values
from tributary.checks.violations import GroupViolations, RowCounts, RowViolations, Violations

__all__ = [
    "Check",
    "GroupViolations",
    "RowCounts",
    "RowViolations",
    "Violations",
    "accepted_range",
    "accepted_values",
    "assert_equal",
    "at_least_one",
    "cardinality_equality",
    "columns_match_set",
    "equal_rowcount",
    "equality",
    "expression_is_true",
    "fewer_rows_than",
    "funnel_order",
    "mutually_exclusive_ranges",
    "not_accepted_values",
    "not_constant",
    "not_empty_string",
    "not_null",
    "not_null_proportion",
    "recency",
    "relationships_where",
    "run_checks",
    "sequential_values",
    "unique",
    "unique_combination_of_columns",
]
