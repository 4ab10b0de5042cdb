"""Rules about the values of a column, over the whole table or within groups.

All of them are one aggregation with partial results on the map side, so a value
or group that holds most of the table arrives as one row from each task.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.checks.violations import GroupViolations, Violations, subset
from tributary.functions._args import as_column, as_value
from tributary.functions.dates import add_parts
from tributary.operators.columns import quoted


def _columns(names: Sequence[str]) -> list[Column]:
    return [as_column(name) for name in names]


def _rows() -> dict[str, Column]:
    """What most rules need to know of a group."""
    return {"n": F.count(F.lit(1))}


def _listed(field: Column, values: Iterable, quote: bool) -> Column:
    """Condition that the field is in the list; unquoted values are SQL expressions."""
    return field.isin([v if quote else F.expr(str(v)) for v in values])


def at_least_one(
    df: DataFrame, column: str, group_by_columns: Sequence[str] = (), where: str | None = None
) -> Violations:
    """There is no non-NULL value in the table, or in a group.

    Without groups each task stops at its first value.
    """
    rows, value = subset(df, where), as_column(column)
    if group_by_columns:
        counts = rows.groupBy(*_columns(group_by_columns)).agg(F.count(value).alias("n_values"))
        return GroupViolations(
            counts.where("n_values = 0"),
            table=None if where else df,
            keys=tuple(_columns(group_by_columns)),
            sums={"n": F.count(value)},
            broken=lambda _, sums: sums["n"] == 0,
        )
    counts = rows.where(value.isNotNull()).limit(1).agg(F.count(F.lit(1)).alias("n_values"))
    return Violations(counts.where("n_values = 0"))


def not_constant(
    df: DataFrame, column: str, group_by_columns: Sequence[str] = (), where: str | None = None
) -> Violations:
    """The table, or a group, has exactly one distinct non-NULL value.

    That is the case if smallest and greatest value agree, which needs no set of values.
    """
    value = as_column(column)
    ends = (
        subset(df, where)
        .groupBy(*_columns(group_by_columns))
        .agg(F.min(value).alias("__low"), F.max(value).alias("__high"))
    )
    constant = ends.where(F.col("__low") == F.col("__high")).drop("__low", "__high")
    return GroupViolations(
        constant.withColumn("n_distinct", F.lit(1).cast("bigint")),
        table=None if where else df,
        keys=tuple(_columns(group_by_columns)),
        sums={"low": F.min(value), "high": F.max(value)},
        broken=lambda _, sums: sums["low"] == sums["high"],
    )


def not_null_proportion(
    df: DataFrame,
    column: str,
    at_least: float,
    at_most: float = 1.0,
    group_by_columns: Sequence[str] = (),
    where: str | None = None,
) -> Violations:
    """The share of non-NULL values is below ``at_least`` or above ``at_most``."""
    share = F.try_divide(F.count(as_column(column)), F.count(F.lit(1)))
    shares = (
        subset(df, where)
        .groupBy(*_columns(group_by_columns))
        .agg(share.alias("not_null_proportion"))
    )
    outside = (F.col("not_null_proportion") < at_least) | (F.col("not_null_proportion") > at_most)
    return GroupViolations(
        shares.where(outside),
        table=None if where else df,
        keys=tuple(_columns(group_by_columns)),
        sums={"share": share},
        broken=lambda _, sums: (sums["share"] < at_least) | (sums["share"] > at_most),
    )


def recency(
    df: DataFrame,
    field: str,
    datepart: str,
    interval: int,
    ignore_time_component: bool = False,
    group_by_columns: Sequence[str] = (),
    as_of=None,
    where: str | None = None,
) -> Violations:
    """The newest value is older than ``interval`` date parts before ``as_of`` (default: now)."""
    now = F.current_timestamp() if as_of is None else as_value(as_of)
    kind = "date" if ignore_time_component else "timestamp"
    newest = F.max(as_column(field))
    if ignore_time_component:
        newest = newest.cast("date")
    result = (
        subset(df, where)
        .groupBy(*_columns(group_by_columns))
        .agg(newest.alias("most_recent"))
        .withColumn("threshold", add_parts(datepart, -interval, now).cast(kind))
    )
    threshold = add_parts(datepart, -interval, now).cast(kind)
    return GroupViolations(
        result.where(F.col("most_recent") < F.col("threshold")),
        table=None if where else df,
        keys=tuple(_columns(group_by_columns)),
        sums={"newest": newest},
        broken=lambda _, sums: sums["newest"] < threshold,
    )


def unique(df: DataFrame, column: str, where: str | None = None) -> Violations:
    """A non-NULL value occurs more than once; one row for each such value, with its count."""
    value = as_column(column)
    counts = (
        subset(df, where)
        .where(value.isNotNull())
        .groupBy(value.alias("unique_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
    )
    return GroupViolations(
        counts.where("n_records > 1"),
        table=None if where else df,
        keys=(value,),
        sums=_rows(),
        broken=lambda keys, sums: keys[0].isNotNull() & (sums["n"] > 1),
    )


def unique_combination_of_columns(
    df: DataFrame, columns: Sequence[str], quote_columns: bool = False, where: str | None = None
) -> Violations:
    """A combination occurs more than once; NULL counts as a value.

    With ``quote_columns`` the columns are plain names, which may hold any character.
    """
    keys = [F.col(quoted(name)) for name in columns] if quote_columns else _columns(columns)
    counts = subset(df, where).groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    return GroupViolations(
        counts.where("__n > 1").drop("__n"),
        table=None if where else df,
        keys=tuple(keys),
        sums=_rows(),
        broken=lambda _, sums: sums["n"] > 1,
    )


def accepted_values(
    df: DataFrame, column: str, values: Iterable, quote: bool = True, where: str | None = None
) -> Violations:
    """A value is not in the list; one row for each such value, with its count."""
    counts = (
        subset(df, where)
        .groupBy(as_column(column).alias("value_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
    )
    allowed = list(values)
    return GroupViolations(
        counts.where(~_listed(F.col("value_field"), allowed, quote)),
        table=None if where else df,
        keys=(as_column(column),),
        sums=_rows(),
        broken=lambda keys, _: ~_listed(keys[0], allowed, quote),
    )


def not_accepted_values(
    df: DataFrame, column: str, values: Iterable, quote: bool = True, where: str | None = None
) -> Violations:
    """A value is in the list of forbidden ones; one row for each such value."""
    found = subset(df, where).select(as_column(column).alias("value_field")).distinct()
    forbidden = list(values)
    return GroupViolations(
        found.where(_listed(F.col("value_field"), forbidden, quote)),
        table=None if where else df,
        keys=(as_column(column),),
        sums=_rows(),
        broken=lambda keys, _: _listed(keys[0], forbidden, quote),
    )
