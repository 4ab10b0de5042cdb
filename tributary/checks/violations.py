from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame


@dataclass(frozen=True)
class Violations:
    """The rows that break a rule, and the metric that counts them.

    ``counted`` has equal rows once, with their number in ``__copies``; where it is given,
    rows are counted there and never written out only to be counted.
    """

    rows: DataFrame
    metric: str = "count(*)"
    counted: DataFrame | None = None


@dataclass(frozen=True)
class RowViolations:
    """The same for a rule about single rows.

    It keeps the checked table and the condition apart, so that a report can count
    many such rules in one pass over the table.
    """

    table: DataFrame
    broken: Column
    shown: tuple[Column, ...] = ()
    metric: str = "count(*)"

    @property
    def rows(self) -> DataFrame:
        found = self.table.where(self.broken)
        return found.select(*self.shown) if self.shown else found


@dataclass(frozen=True)
class RowCounts(Violations):
    """The same for a rule that one row can break several times, ``per_row`` times."""

    table: DataFrame | None = None
    per_row: Column | None = None


@dataclass(frozen=True)
class GroupViolations(Violations):
    """The same for a rule about groups of rows.

    It keeps the table, the keys, the aggregates and the condition on a group apart, so that
    a report can evaluate many such rules in one pass over the table. ``broken`` gets the keys
    and the aggregates by name. ``table`` is missing if the rule holds for some rows only.
    """

    table: DataFrame | None = None
    keys: tuple[Column, ...] = ()
    sums: Mapping[str, Column] = field(default_factory=dict)
    broken: Callable[[Sequence[Column], Mapping[str, Column]], Column] | None = None


def subset(df: DataFrame, where: str | None) -> DataFrame:
    return df.where(where) if where else df
