"""Pivot, unpivot, and a union of tables with different columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType

from tributary.functions._args import sql_text
from tributary.functions.text import slugify
from tributary.operators.columns import quoted


def pivot(
    column: str,
    values: Iterable,
    alias: bool = True,
    agg: str = "sum",
    cmp: str = "=",
    prefix: str = "",
    suffix: str = "",
    then_value=1,
    else_value=0,
    quote_identifiers: bool = True,
    distinct: bool = False,
) -> list[Column]:
    """One aggregate for each value, to pass to ``groupBy(...).agg(*pivot(...))``.

    Rows whose ``column`` compares true with the value contribute ``then_value``,
    the others ``else_value``; both are SQL text or numbers. Columns are named by
    the value, or by its slug if ``quote_identifiers`` is off. All the aggregates
    share one grouping pass.
    """
    aggregates = []
    for value in values:
        case = (
            f"case when {column} {cmp} {sql_text(value)}"
            f" then {then_value} else {else_value} end"
        )
        aggregate = F.expr(f"{agg}({'distinct ' if distinct else ''}{case})")
        name = f"{prefix}{value}{suffix}"
        if alias:
            aggregate = aggregate.alias(name if quote_identifiers else slugify(name))
        aggregates.append(aggregate)
    return aggregates


def wide_pivot(
    df: DataFrame,
    group_by: Iterable[str],
    column: str,
    values: Iterable,
    agg: str = "sum",
    prefix: str = "",
    suffix: str = "",
    then_value=1,
    else_value: int | None = 0,
    quote_identifiers: bool = True,
) -> DataFrame:
    """The table that ``groupBy(...).agg(*pivot(...))`` gives, for thousands of values.

    Rows are first combined by key and value, and the finished numbers are then put in their
    places, two aggregations that do not grow with the number of values; one CASE for each
    value would soon exceed what can be compiled. Values are compared as text. ``agg`` is
    sum, count, min or max, and ``else_value`` 0 or ``None``.
    """
    if agg not in ("sum", "count", "min", "max"):
        raise ValueError(f"agg must be sum, count, min or max, got {agg}")
    if else_value not in (0, None):
        raise ValueError(f"else_value must be 0 or None, got {else_value}")
    keys, texts = list(group_by), list(dict.fromkeys(str(value) for value in values))
    names = [f"{prefix}{text}{suffix}" for text in texts]
    if not quote_identifiers:
        names = [slugify(name) for name in names]
    if not texts:
        return df.select(*[F.col(quoted(key)) for key in keys]).distinct()
    own = [F.col(quoted(key)).alias(key) for key in keys]
    key = [F.col(quoted(name)) for name in keys]
    narrowed = df.select(
        *own, F.expr(column).cast("string").alias("__value"), F.expr(str(then_value)).alias("__then")
    )
    parts = narrowed.groupBy(*key, "__value").agg(
        F.expr(f"{agg}(__then)").alias("__part"), F.count(F.lit(1)).alias("__rows")
    )
    part, others, none = F.col("__part"), F.col("__all") - F.col("__rows"), F.lit(0)
    if else_value is None:
        met, unmet = part, none if agg == "count" else F.lit(None)
    elif agg == "count":  # rows of other values count too
        met, unmet = part + others, F.col("__all")
    else:
        with_else = {"sum": F.coalesce(part, none), "min": F.least(part, none), "max": F.greatest(part, none)}
        met, unmet = F.when(others == 0, part).otherwise(with_else[agg]), none
    kind = parts.schema["__part"].dataType
    places = df.sparkSession.createDataFrame(
        list(zip(texts, range(len(texts)), strict=True)), "__value string, __place int"
    )  # the caller's list, one row for each column asked for
    counted = parts.withColumn("__all", F.sum("__rows").over(Window.partitionBy(*key)))
    found = counted.join(F.broadcast(places), "__value").select(
        *key, "__place", "__all", met.cast(kind).alias("__met"), F.lit(1).alias("__known")
    )
    every = F.explode(F.sequence(F.lit(0), F.lit(len(texts) - 1))).alias("__place")
    asked = counted.groupBy(*key).agg(F.first("__all").alias("__all")).select(
        *key, every, "__all", F.lit(None).cast(kind).alias("__met"), F.lit(0).alias("__known")
    )
    placed = (
        found.union(asked)
        .groupBy(*key, "__place")
        .agg(*[F.max(name).alias(name) for name in ("__all", "__met", "__known")])
        .withColumn("__number", F.when(F.col("__known") == 1, F.col("__met")).otherwise(unmet.cast(kind)))
        .groupBy(*key)
        .agg(F.sort_array(F.collect_list(F.struct("__place", "__number")))["__number"].alias("__row"))
    )
    columns = [f"__row[{i}] as {quoted(name)}" for i, name in enumerate(names)]
    return placed.selectExpr(*[quoted(name) for name in keys], *columns)


def unpivot(
    df: DataFrame,
    cast_to: str | DataType = "string",
    exclude: Iterable[str] = (),
    remove: Iterable[str] = (),
    field_name: str = "field_name",
    value_name: str = "value",
) -> DataFrame:
    """One row for each row and column: the kept columns, the column's name, its value.

    ``exclude`` columns are kept as they are, ``remove`` columns are dropped. The
    table is read once and NULL values stay.
    """
    kept = list(exclude)
    left_out = {name.lower() for name in [*kept, *remove]}
    molten = [field for field in df.schema if field.name.lower() not in left_out]

    def as_value(field) -> Column:
        column = F.col(quoted(field.name))
        if isinstance(field.dataType, BooleanType):
            column = column.cast("string")
        return column.cast(cast_to).alias(field.name)

    ids = [F.col(quoted(name)).alias(name) for name in kept]
    narrowed = df.select(*ids, *[as_value(field) for field in molten])
    return narrowed.unpivot(
        [F.col(quoted(name)) for name in kept],
        [F.col(quoted(field.name)) for field in molten],
        field_name,
        value_name,
    )


def union_all(tables: list[DataFrame]) -> DataFrame:
    """Union in pairs: plans of hundreds of tables stay shallow and are analysed quickly."""
    while len(tables) > 1:
        pairs = [tables[i : i + 2] for i in range(0, len(tables), 2)]
        tables = [pair[0].union(pair[1]) if len(pair) == 2 else pair[0] for pair in pairs]
    return tables[0]


def union_relations(
    relations: Mapping[str, DataFrame],
    column_override: Mapping[str, str | DataType] | None = None,
    include: Iterable[str] = (),
    exclude: Iterable[str] = (),
    source_column_name: str | None = "_source_relation",
    where: str | None = None,
) -> DataFrame:
    """UNION ALL of named tables whose columns differ.

    The result has every column of any table, in the order and with the type in
    which it is first met, unless ``column_override`` gives another type. A table
    without a column gives NULL for it. ``where`` is applied to each table before
    the union, so it still reaches the scan.
    """
    included = {name.lower() for name in include}
    excluded = {name.lower() for name in exclude}
    if included and excluded:
        raise ValueError("give include or exclude, not both")
    if not relations:
        raise ValueError("there are no tables to union")

    types: dict[str, tuple[str, DataType]] = {}
    for table in relations.values():
        for field in table.schema:
            key = field.name.lower()
            if key in excluded or (included and key not in included):
                continue
            types.setdefault(key, (field.name, field.dataType))
    if not types:
        raise ValueError(f"no columns are left to union in {', '.join(relations)}")
    overrides = {name.lower(): kind for name, kind in (column_override or {}).items()}

    parts = []
    for source, table in relations.items():
        present = {name.lower(): name for name in table.columns}
        columns = []
        if source_column_name is not None:
            columns.append(F.lit(source).alias(source_column_name))
        for key, (name, kind) in types.items():
            column = F.col(quoted(present[key])) if key in present else F.lit(None)
            columns.append(column.cast(overrides.get(key, kind)).alias(name))
        rows = table.where(where) if where else table
        parts.append(rows.select(*columns))
    return union_all(parts)
