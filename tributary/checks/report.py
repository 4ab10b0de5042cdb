"""Many checks, one result table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.checks.violations import GroupViolations, RowCounts, RowViolations, Violations
from tributary.functions._args import sql_text
from tributary.operators.reshape import union_all


@dataclass(frozen=True)
class Check:
    """A named check with the conditions on its number of failures.

    With severity "warn" the check never fails. ``metric`` replaces the metric of
    the violations.
    """

    name: str
    violations: Violations | RowViolations
    error_if: str = "!= 0"
    warn_if: str = "!= 0"
    severity: str = "error"
    metric: str | None = None

    def outcome(self, failures: str) -> str:
        """SQL text of the result row, given the SQL text of the number of failures."""
        failed = f"when {failures} {self.error_if} then 'fail'" if self.severity == "error" else ""
        status = f"case {failed} when {failures} {self.warn_if} then 'warn' else 'pass' end"
        name = sql_text(self.name)
        return f"named_struct('check', {name}, 'failures', {failures}, 'status', {status})"


def _shared_results(checks: list[Check]) -> DataFrame:
    """Results of all rules on rows and groups of one table, from a single pass over it.

    Rules on groups become grouping sets of one aggregation: a row is written out once for
    each set and combined with others before the one shuffle. Rules on rows are sums of the
    empty set, the whole table.
    """
    table = checks[0].violations.table
    groups = [(i, c.violations) for i, c in enumerate(checks) if isinstance(c.violations, GroupViolations)]
    sums = [
        _row_sum(check.violations).alias(f"failures_{i}")
        for i, check in enumerate(checks)
        if not isinstance(check.violations, GroupViolations)
    ]
    if groups:
        counted = _grouped(table, groups, sums)
    else:
        counted = table.agg(*sums)
    results = ", ".join(
        check.outcome(f"coalesce(failures_{i}, 0L)") for i, check in enumerate(checks)
    )
    return counted.selectExpr(f"inline(array({results}))")


def _row_sum(rule: RowViolations | RowCounts) -> Column:
    if isinstance(rule, RowCounts):
        return F.sum(rule.per_row).cast("bigint")
    return F.count_if(rule.broken)


def _grouped(
    table: DataFrame, groups: list[tuple[int, GroupViolations]], sums: list[Column]
) -> DataFrame:
    """One row with the failures of each rule; ``sums`` are those of the whole table."""
    names = {i: [f"__{i}_key{j}" for j in range(len(rule.keys))] for i, rule in groups}
    every = [name for own in names.values() for name in own]
    # Without keys a rule belongs to the empty set, like the rules on rows.
    sets = [[], *[own for own in names.values() if own]]
    keyed = table.withColumns(
        {name: key for i, rule in groups for name, key in zip(names[i], rule.keys, strict=True)}
    )
    more = [
        column.alias(f"__{i}_{name}") for i, rule in groups for name, column in rule.sums.items()
    ]
    if every:
        columns = [F.col(name) for name in every]
        found = keyed.groupingSets([[F.col(n) for n in own] for own in sets], *columns).agg(
            F.grouping_id().alias("__set"), *more, *sums
        )
    else:
        found = keyed.agg(F.lit(0).cast("bigint").alias("__set"), *more, *sums)
    whole = (1 << len(every)) - 1  # a bit for each key that is not in the set, the first highest
    failures = []
    for i, rule in groups:
        own = sum(1 << (len(every) - 1 - every.index(name)) for name in names[i])
        keys = [F.col(name) for name in names[i]]
        broken = rule.broken(keys, {name: F.col(f"__{i}_{name}") for name in rule.sums})
        failures.append(F.count_if((F.col("__set") == whole - own) & broken).alias(f"failures_{i}"))
    rows = found.columns[len(found.columns) - len(sums) :] if sums else []
    of_table = [F.max(F.when(F.col("__set") == whole, F.col(name))).alias(name) for name in rows]
    return found.agg(*failures, *of_table)


def _result(check: Check) -> DataFrame:
    metric, rows = check.metric or check.violations.metric, check.violations.rows
    if metric == "count(*)" and getattr(check.violations, "counted", None) is not None:
        metric, rows = "sum(__copies)", check.violations.counted
    counted = rows.agg(
        F.expr(f"coalesce(cast({metric} as bigint), 0) as failures")
    )
    return counted.selectExpr(f"inline(array({check.outcome('failures')}))")


def _shares_a_pass(check: Check) -> bool:
    rule = check.violations
    known = isinstance(rule, RowViolations | RowCounts | GroupViolations)
    return known and rule.table is not None and not check.metric and rule.metric == "count(*)"


def run_checks(checks: Sequence[Check]) -> DataFrame:
    """``(check, failures, status)`` for every check; status is pass, warn or fail.

    Rules about rows and groups of the same DataFrame share one scan and one shuffle however
    many there are; every other check is one aggregation. The result has a row for each check.
    """
    if not checks:
        raise ValueError("there are no checks to run")
    shared: dict[int, list[Check]] = {}
    results = []
    for check in checks:
        if _shares_a_pass(check):
            shared.setdefault(id(check.violations.table), []).append(check)
        else:
            results.append(_result(check))
    results += [_shared_results(group) for group in shared.values()]
    return union_all(results)
