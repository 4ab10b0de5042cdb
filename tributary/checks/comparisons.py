"""Rules about two tables.

The tables are stacked, marked by side, and compared in one aggregation: one
shuffle instead of one for each side and direction, with partial results on the map
side, so that no join meets a skewed key.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DecimalType, DoubleType, FloatType, StructType

from tributary.checks.violations import Violations, subset
from tributary.functions._args import as_column
from tributary.operators.columns import filtered_columns, quoted
from tributary.operators.ordering import repeat_rows


def _stack(left: DataFrame, right: DataFrame) -> DataFrame:
    """Both tables, with ``__left`` = 1 for a row of the first and ``__right`` = 1 otherwise."""
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    return left.select("*", one.alias("__left"), none.alias("__right")).union(
        right.select("*", none.alias("__left"), one.alias("__right"))
    )


def _comparable(df: DataFrame, names: Sequence[str], rounded: set[str], precision) -> list[Column]:
    columns = []
    for name in names:
        column = F.col(quoted(name))
        if precision is not None and name.lower() in rounded:
            column = F.round(column, precision)
        columns.append(column.alias(name))
    return columns


def equality(
    df: DataFrame,
    compare: DataFrame,
    compare_columns: Iterable[str] | None = None,
    exclude_columns: Iterable[str] | None = None,
    precision: int | None = None,
    where: str | None = None,
    by_digests: bool = False,
) -> Violations:
    """Rows found in one table only, marked ``a_minus_b`` or ``b_minus_a``.

    Tables are compared as sets: how often a row occurs does not matter, and NULL
    equals NULL. Floating-point and decimal columns can first be rounded, in their own type,
    to ``precision`` digits after the point.

    With ``by_digests`` both tables are first read for digests of hash buckets, summed in each
    task, and only rows of buckets whose digests differ are shuffled: none of tables that hold
    equal rows equally often. The rows found are the same.
    """
    if precision is not None and not 0 <= precision <= 38:
        raise ValueError(f"precision must be from 0 to 38, got {precision}")
    if compare_columns and exclude_columns:
        raise ValueError("give compare_columns or exclude_columns, not both")
    names = list(compare_columns or filtered_columns(df, exclude_columns or ()))
    if not compare_columns:
        other = filtered_columns(compare, exclude_columns or ())
        if {name.lower() for name in names} != {name.lower() for name in other}:
            raise ValueError("the tables have different columns; compare or exclude some")
    rounded = {
        field.name.lower()
        for field in df.schema
        if isinstance(field.dataType, FloatType | DoubleType | DecimalType)
    }
    left = subset(df, where).select(_comparable(df, names, rounded, precision))
    right = compare.select(_comparable(compare, names, rounded, precision))
    if by_digests:
        left, right = _where_digests_differ(left, right)
    stacked = _stack(left, right)
    sides = stacked.groupBy(*[F.col(quoted(name)) for name in names]).agg(
        F.max("__left").alias("__left"), F.max("__right").alias("__right")
    )
    one_sided = sides.where("__left <> __right").select(
        F.when(F.col("__left") == 1, "a_minus_b").otherwise("b_minus_a").alias("which_diff"),
        *[F.col(quoted(name)) for name in names],
    )
    return Violations(
        one_sided,
        "count(*) + coalesce(abs("
        "count_if(which_diff = 'a_minus_b') - count_if(which_diff = 'b_minus_a')), 0)",
    )


#: Hash buckets that are told apart by digests.
_BUCKETS = 4096


def _hashes(df: DataFrame) -> tuple[Column, Column]:
    """Two hashes of a whole row, equal for rows that are equal in groups."""
    parts = []
    for column in df.schema:
        value = F.col(quoted(column.name))
        if isinstance(column.dataType, FloatType | DoubleType):
            value = F.when(value == 0, F.lit(0).cast(column.dataType)).otherwise(value)
        elif isinstance(column.dataType, StructType | ArrayType):
            value = F.to_json(F.struct(value), {"ignoreNullFields": "false"})
        # A hash passes NULL over, so its place is hashed too.
        parts += [value.isNull(), value]
    return F.xxhash64(F.lit(1), *parts), F.xxhash64(F.lit(2), *parts)


def _where_digests_differ(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of both tables in hash buckets whose rows differ in any way."""
    sides = []
    for df, sign in ((left, 1), (right, -1)):
        one, two = (value.cast("decimal(20,0)") * sign for value in _hashes(df))
        bucket = F.pmod(_hashes(df)[0], F.lit(_BUCKETS))
        sides.append(
            df.select(bucket.alias("__bucket"), F.lit(sign).cast("bigint").alias("__n"),
                      one.alias("__one"), two.alias("__two"))
        )
    sums = sides[0].union(sides[1]).groupBy("__bucket").agg(
        *[F.sum(name).alias(name) for name in ("__n", "__one", "__two")]
    )
    differing = F.broadcast(
        sums.where("__n <> 0 or __one <> 0 or __two <> 0").select("__bucket")
    )  # no more than there are buckets
    return tuple(
        df.withColumn("__bucket", F.pmod(_hashes(df)[0], F.lit(_BUCKETS)))
        .join(differing, "__bucket", "left_semi")
        .drop("__bucket")
        for df in (left, right)
    )


def cardinality_equality(
    df: DataFrame, column: str, to: DataFrame, field: str, where: str | None = None
) -> Violations:
    """A value does not occur equally often in both columns; one row for each side that has it."""
    value = column.split(".")[-1].strip("`")
    counts = (
        _stack(
            subset(df, where).select(as_column(column).alias(value)),
            to.select(as_column(field).alias(value)),
        )
        .groupBy(F.col(quoted(value)))
        .agg(F.sum("__left").alias("__left"), F.sum("__right").alias("__right"))
        .where("__left <> __right")
    )
    present = F.filter(F.array("__left", "__right"), lambda n: n > 0)
    return Violations(counts.select(F.col(quoted(value)), F.explode(present).alias("num_rows")))


def _paired_counts(df: DataFrame, compare: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows of each group on both sides; a side without the group has NULL.

    A group with NULL in its key never equals a group of the other side, as in an
    equi-join, so such groups are kept apart by side. Without groups each side is a count of
    its own, which a source may know from its files (see ``sources.read_footers``).
    """
    if not names:
        one, none = F.count(F.lit(1)), F.lit(0).cast("bigint")
        ours = df.agg(one.alias("n")).select(F.col("n").alias("__n_a"), none.alias("__n_b"))
        theirs = compare.agg(one.alias("n")).select(none.alias("__n_a"), F.col("n").alias("__n_b"))
        both = ours.union(theirs).agg(F.sum("__n_a").alias("__n_a"), F.sum("__n_b").alias("__n_b"))
        counted = both.where("__n_a > 0 or __n_b > 0")
        return counted.select(
            *[F.nullif(F.col(n), none).alias(n) for n in ("__n_a", "__n_b")]
        )
    keys = [as_column(name).alias(f"__key{i}") for i, name in enumerate(names)]
    stacked = _stack(df.select(*keys), compare.select(*keys))
    key_names = [f"__key{i}" for i in range(len(names))]
    unmatched = F.lit(False)
    for key in key_names:
        unmatched = unmatched | F.col(key).isNull()
    counts = stacked.groupBy(
        *key_names, F.when(unmatched, F.col("__left")).otherwise(F.lit(-1)).alias("__apart")
    ).agg(F.sum("__left").alias("__left"), F.sum("__right").alias("__right"))
    columns = []
    for name, key in zip(names, key_names, strict=True):
        for side, suffix in (("__left", "a"), ("__right", "b")):
            columns.append(F.when(F.col(side) > 0, F.col(key)).alias(f"{name}_{suffix}"))
    left, right = (F.nullif(F.col(side), F.lit(0).cast("bigint")) for side in ("__left", "__right"))
    return counts.select(*columns, left.alias("__n_a"), right.alias("__n_b"))


def _one_sided_as_zero(counts: DataFrame, strict: bool) -> DataFrame:
    return counts.fillna(0, ["__n_a", "__n_b"]) if strict else counts


def equal_rowcount(
    df: DataFrame,
    compare: DataFrame,
    group_by_columns: Sequence[str] = (),
    strict: bool = False,
    where: str | None = None,
) -> Violations:
    """The tables, or groups of them, have different numbers of rows.

    Every group is listed; the metric adds up the differences. A group found on
    one side only has no difference and passes, unless ``strict``.
    """
    pairs = _paired_counts(subset(df, where), compare, group_by_columns)
    counts = _one_sided_as_zero(pairs, strict)
    rows = counts.withColumn("diff_count", F.abs(F.col("__n_a") - F.col("__n_b")))
    return Violations(
        rows.withColumnsRenamed({"__n_a": "count_a", "__n_b": "count_b"}),
        "sum(coalesce(diff_count, 0))",
    )


def fewer_rows_than(
    df: DataFrame,
    compare: DataFrame,
    group_by_columns: Sequence[str] = (),
    strict: bool = False,
    where: str | None = None,
) -> Violations:
    """The table, or a group, does not have fewer rows than the other.

    The metric adds up the surplus, or 1 where the numbers are equal. A group found
    on one side only passes, unless ``strict``.
    """
    pairs = _paired_counts(subset(df, where), compare, group_by_columns)
    counts = _one_sided_as_zero(pairs, strict)
    ours, theirs = F.col("__n_a"), F.col("__n_b")
    delta = F.when(ours > theirs, ours - theirs).when(ours == theirs, 1).otherwise(0)
    rows = counts.withColumn("row_count_delta", delta.cast("bigint"))
    return Violations(
        rows.withColumnsRenamed(
            {"__n_a": "count_our_model", "__n_b": "count_comparison_model"}
        ),
        "sum(coalesce(row_count_delta, 0))",
    )


def relationships_where(
    df: DataFrame,
    column: str,
    to: DataFrame,
    field: str,
    from_condition: str = "1=1",
    to_condition: str = "1=1",
    where: str | None = None,
) -> Violations:
    """A value is missing from the other table's column; NULL values are ignored.

    Values are counted before they are compared, so one that holds a third of the
    rows costs no more than a rare one, until its rows are written out again.
    """
    ours, theirs = as_column(column), as_column(field)
    children = subset(df, where).where(ours.isNotNull() & F.expr(from_condition))
    parents = to.where(theirs.isNotNull() & F.expr(to_condition))
    counts = (
        _stack(children.select(ours.alias("id")), parents.select(theirs.alias("id")))
        .groupBy("id")
        .agg(F.sum("__left").alias("__copies"), F.max("__right").alias("__known"))
    )
    missing = F.lit(None).cast(parents.select(theirs).schema[0].dataType).alias("right_id")
    orphans = counts.where("__known = 0").select("id", missing, "__copies")
    return Violations(repeat_rows(orphans, "__copies"), counted=orphans)


def columns_match_set(df: DataFrame, column_list: Iterable[str]) -> Violations:
    """A column is missing from the table or from the list; letter case is ignored."""
    actual = {name.lower() for name in df.columns}
    expected = {name.lower() for name in column_list}
    differing = [
        (name if name in actual else None, name if name in expected else None)
        for name in sorted(actual ^ expected)
    ]
    return Violations(
        df.sparkSession.createDataFrame(differing, "relation_column string, input_column string")
    )
