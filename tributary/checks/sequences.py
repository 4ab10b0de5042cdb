"""Rules about neighbouring rows in an order.

Equal rows are first merged into one with a count, then neighbours are looked up
in range-partitioned slices (``operators.ordering``): neither a huge group, nor a
table without groups, nor one value repeated everywhere ends up in a single task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.checks.violations import Violations, subset
from tributary.functions._args import as_column
from tributary.functions.dates import add_parts
from tributary.functions.text import slugify
from tributary.operators.ordering import neighbours, repeat_rows

_GAP_RULES = {
    "not_allowed": ("=", "equal_to"),
    "allowed": ("<=", "less_than_or_equal_to"),
    "required": ("<", "less_than"),
}


def sequential_values(
    df: DataFrame,
    column: str,
    interval: int = 1,
    datepart: str | None = None,
    group_by_columns: Sequence[str] = (),
    where: str | None = None,
) -> Violations:
    """A value is not the previous one plus ``interval`` (a number, or date parts).

    The first value of the table or group passes.
    """
    groups = list(group_by_columns)
    previous_name = f"previous_{slugify(column)}"

    def broken(value: Column, before: Column) -> Column:
        if datepart:
            return ~(value.cast("timestamp") == add_parts(datepart, interval, before))
        return ~(value == before + F.lit(interval))

    distinct = (
        subset(df, where)
        .groupBy(*[as_column(name).alias(f"__g{i}") for i, name in enumerate(groups)],
                 as_column(column).alias("__v"))
        .agg(F.count(F.lit(1)).alias("__n"))
    )
    repeated = F.col("__n") > 1
    found = neighbours(
        distinct,
        [f"__g{i}" for i in range(len(groups))],
        ["__v"],
        carry="__v",
        previous=True,
        keep=lambda near: repeated | broken(F.col("__v"), near["value"]),
    )
    # The first copy follows the previous value, each further copy follows its equal.
    copies = F.expr("""explode(array(
        named_struct('before', neighbour.value, 'n', 1L),
        named_struct('before', __v, 'n', __n - 1)
    ))""")
    pairs = found.withColumn("__pair", copies).where(
        broken(F.col("__v"), F.col("__pair")["before"])
    )
    rows = pairs.select(
        *[F.col(f"__g{i}").alias(name) for i, name in enumerate(groups)],
        F.col("__v").alias(column),
        F.col("__pair")["before"].alias(previous_name),
        F.col("__pair")["n"].alias("__copies"),
    )
    return Violations(repeat_rows(rows, "__copies"), counted=rows)


def mutually_exclusive_ranges(
    df: DataFrame,
    lower_bound_column: str,
    upper_bound_column: str,
    partition_by: str | None = None,
    gaps: str = "allowed",
    zero_length_range_allowed: bool = False,
    where: str | None = None,
) -> Violations:
    """A range is inverted, overlaps the next one, or breaks the rule about gaps.

    Columns may be SQL expressions. Unlike in the other checks a NULL comparison
    counts as broken: bounds are meant to be known.
    """
    if gaps not in _GAP_RULES:
        raise ValueError(f"gaps must be one of {', '.join(_GAP_RULES)}, got {gaps!r}")
    gap_operator, gap_words = _GAP_RULES[gaps]
    length_operator, length_words = (
        ("<=", "less_than_or_equal_to") if zero_length_range_allowed else ("<", "less_than")
    )
    length_name = f"lower_bound_{length_words}_upper_bound"
    gap_name = f"upper_bound_{gap_words}_next_lower_bound"
    groups = ["partition_by_col"] if partition_by else []
    lower, upper = F.col("lower_bound"), F.col("upper_bound")

    def holds(left: Column, operator: str, right: Column) -> Column:
        return {"=": left == right, "<=": left <= right, "<": left < right}[operator]

    length_ok = F.coalesce(holds(lower, length_operator, upper), F.lit(False))

    def gap_ok(next_lower: Column, is_last: Column) -> Column:
        return F.coalesce(holds(upper, gap_operator, next_lower), is_last, F.lit(False))

    keys = [as_column(partition_by).alias("partition_by_col")] if partition_by else []
    distinct = (
        subset(df, where)
        .groupBy(
            *keys,
            as_column(lower_bound_column).alias("lower_bound"),
            as_column(upper_bound_column).alias("upper_bound"),
        )
        .agg(F.count(F.lit(1)).alias("__n"))
    )
    found = neighbours(
        distinct,
        groups,
        ["lower_bound", "upper_bound"],
        carry="lower_bound",
        previous=False,
        keep=lambda near: (F.col("__n") > 1) | ~(length_ok & gap_ok(near["value"], near.isNull())),
    )
    # All copies but the last are followed by their equal.
    copies = F.expr("""explode(array(
        named_struct('next', neighbour.value, 'is_last', neighbour is null, 'n', 1L),
        named_struct('next', lower_bound, 'is_last', false, 'n', __n - 1)
    ))""")
    rows = found.withColumn("__pair", copies).select(
        *groups,
        "lower_bound",
        "upper_bound",
        F.col("__pair")["next"].alias("next_lower_bound"),
        F.col("__pair")["is_last"].alias("is_last_record"),
        length_ok.alias(length_name),
        gap_ok(F.col("__pair")["next"], F.col("__pair")["is_last"]).alias(gap_name),
        F.col("__pair")["n"].alias("__copies"),
    )
    broken = rows.where(~(F.col(length_name) & F.col(gap_name)))
    return Violations(repeat_rows(broken, "__copies"), counted=broken)
