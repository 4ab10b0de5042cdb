"""DataFrame helpers: column lists, reshaping, first rows, series, small results."""

from tributary.operators.columns import (
    filtered_columns,
    group_by_first,
    nullcheck,
    nullcheck_table,
    star,
)
from tributary.operators.dedupe import deduplicate
from tributary.operators.reshape import pivot, union_relations, unpivot, wide_pivot
from tributary.operators.results import (
    column_value_counts,
    column_values,
    results_as_dict,
    single_value,
)
from tributary.operators.series import date_spine, generate_series

__all__ = [
    "column_value_counts",
    "column_values",
    "date_spine",
    "deduplicate",
    "filtered_columns",
    "generate_series",
    "group_by_first",
    "nullcheck",
    "nullcheck_table",
    "pivot",
    "results_as_dict",
    "single_value",
    "star",
    "union_relations",
    "unpivot",
    "wide_pivot",
]
