from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tributary import operators as op
from tributary.operators.ordering import repeat_rows
from tests.conftest import values

COLORS = [("S", "red"), ("S", "blue"), ("S", "blue's"), ("M", "red")]


@pytest.fixture
def letters(table):
    return table("field_1 string, field_2 string, field_3 string", "abc", "def", "ghi")


def test_star(letters):
    assert letters.select(op.star(letters, exclude=["FIELD_3"])).columns == ["field_1", "field_2"]
    renamed = letters.select(op.star(letters, prefix="prefix_", suffix="_suffix"))
    assert renamed.columns == [f"prefix_field_{i}_suffix" for i in (1, 2, 3)]
    assert op.star(letters, exclude=letters.columns) == []
    aliased = letters.alias("l").join(letters.alias("r"), F.expr("l.field_1 = r.field_1"))
    assert aliased.select(op.star(letters, "r")).count() == 3


def test_star_columns_still_group(table):
    df = table("g1 string, g2 string, v int", ("a", "b", 1), ("a", "b", 2), ("c", "d", 3), ("c", "e", 4))
    grouped = df.groupBy(op.star(df, exclude=["v"])).agg(F.sum("v"))
    assert values(grouped) == [("a", "b", 3), ("c", "d", 3), ("c", "e", 4)]


def test_filtered_columns(letters):
    names = op.filtered_columns(letters, ["Field_1"])
    assert values(letters.agg(*[F.max(name) for name in names])) == [("h", "i")]


def test_nullcheck(table):
    df = table("a string, b string, c int", ("x", "", 1), ("", "y", 2), ("", None, 3))
    assert values(op.nullcheck_table(df)) == [(None, None, 3), (None, "y", 2), ("x", None, 1)]
    assert values(df.select(op.nullcheck(df, ["a"]))) == [(None,), (None,), ("x",)]


def test_group_by_first(table):
    df = table("a string, b string, c int", ("a", "b", 1), ("a", "b", 2))
    assert values(op.group_by_first(df, 2).count()) == [("a", "b", 2)]


def test_deduplicate(table):
    df = table("user_id int, event string, version int", (1, "play", 1), (1, "play", 2), (2, "pause", 1))
    assert values(op.deduplicate(df.where("user_id = 1"), "user_id", "version desc")) == [
        (1, "play", 2)
    ]
    nulls = table("k int, v string", (None, "b"), (None, None), (1, None))
    assert values(op.deduplicate(nulls, "k", "v desc")) == [(None, "b"), (1, None)]


def test_pivot(table):
    df = table("size string, color string", *COLORS)
    out = df.groupBy("size").agg(*op.pivot("color", ["red", "blue"]))
    assert out.columns == ["size", "red", "blue"]
    assert values(out) == [("M", 1, 0), ("S", 1, 1)]
    slugs = df.groupBy("size").agg(*op.pivot("color", ["red", "blue's"], quote_identifiers=False))
    assert slugs.columns == ["size", "red", "blues"]
    assert values(slugs) == [("M", 1, 0), ("S", 1, 1)]


def test_pivot_options(table):
    df = table("g string, k int, v int", ("a", 1, 5), ("a", 2, 5), ("a", 2, 7))
    columns = op.pivot(
        "k", [1, 2], agg="count", cmp="<=", prefix="p_", suffix="_s", then_value="v",
        else_value="null", distinct=True,
    )
    out = df.groupBy("g").agg(*columns)
    assert out.columns == ["g", "p_1_s", "p_2_s"]
    assert values(out) == [("a", 1, 2)]
    assert df.groupBy("g").agg(*op.pivot("k", [1], alias=False)).columns[1].startswith("sum(")


@pytest.mark.parametrize("agg", ["sum", "count", "min", "max"])
@pytest.mark.parametrize("otherwise", [0, None])
def test_wide_pivot_is_the_pivot(table, agg, otherwise):
    rows = [("a", 1, 5), ("a", 2, -5), ("a", 2, 7), ("b", 1, None), ("b", 1, None), ("c", 3, 4),
            (None, 2, 1), ("d", None, 2), ("e", 2, None), ("e", 3, 1), ("f", 1, -2)]
    df = table("`my key` string, k int, v int", *rows)
    columns = op.pivot("k", [1, 2, 9], agg=agg, prefix="p.", suffix="`s", then_value="v",
                       else_value="null" if otherwise is None else otherwise)
    plain = df.groupBy("my key").agg(*columns)
    wide = op.wide_pivot(df, ["my key"], "k", [1, 2, 9], agg, "p.", "`s", "v", otherwise)
    assert wide.columns == plain.columns
    assert [kind for _, kind in wide.dtypes] == [kind for _, kind in plain.dtypes]
    assert sorted(map(repr, wide.collect())) == sorted(map(repr, plain.collect()))


def test_wide_pivot_of_thousands_of_values(spark):
    df = spark.range(20_000).selectExpr("id % 3 as g", "cast(id % 5003 as string) as k", "id as v")
    wide = op.wide_pivot(df, ["g"], "k", range(5000), then_value="v", prefix="n ", quote_identifiers=False)
    assert wide.columns == ["g", *(f"n_{i}" for i in range(5000))]
    rows = {r[0]: r[1:] for r in wide.collect()}
    for g in range(3):
        wanted = [0] * 5003
        for i in range(g, 20_000, 3):
            wanted[i % 5003] += i
        assert list(rows[g]) == wanted[:5000]
    plans = [
        op.wide_pivot(df, ["g"], "k", range(n), then_value="v")._jdf.queryExecution().executedPlan().toString()
        for n in (3, 300)
    ]
    assert len({text.count("Exchange") for text in plans}) == 1


def test_wide_pivot_options(table):
    df = table("g string, k string", ("a", "x y"), ("a", "z"))
    out = op.wide_pivot(df, ["g"], "upper(k)", ["X Y"], quote_identifiers=False)
    assert out.columns == ["g", "x_y"] and values(out) == [("a", 1)]
    assert values(op.wide_pivot(df, ["g"], "k", [])) == [("a",)]
    with pytest.raises(ValueError, match="agg"):
        op.wide_pivot(df, ["g"], "k", ["z"], agg="avg")
    with pytest.raises(ValueError, match="else_value"):
        op.wide_pivot(df, ["g"], "k", ["z"], else_value=3)


def test_unpivot(table):
    df = table(
        "customer_id int, created_at string, status string, segment string, name string",
        (123, "2017-01-01", "active", "tier 1", "name 1"),
        (567, "2017-03-01", "churned", None, "name 2"),
    )
    out = op.unpivot(
        df, exclude=["customer_id", "created_at"], remove=["NAME"], field_name="prop", value_name="val"
    )
    assert out.columns == ["customer_id", "created_at", "prop", "val"]
    assert values(out) == [
        (123, "2017-01-01", "segment", "tier 1"),
        (123, "2017-01-01", "status", "active"),
        (567, "2017-03-01", "segment", None),
        (567, "2017-03-01", "status", "churned"),
    ]
    assert op.unpivot(df).columns == ["field_name", "value"]


def test_unpivot_booleans_and_letter_case(table):
    df = table("Id int, Is_On boolean, N int", (1, True, 3), (2, None, None))
    assert values(op.unpivot(df, exclude=["Id"], field_name="Prop", value_name="Val")) == [
        (1, "Is_On", "true"), (1, "N", "3"), (2, "Is_On", None), (2, "N", None),
    ]


@pytest.fixture
def people(table):
    return {
        "one": table("id int, name string, n string", (1, "drew", "pi"), (2, "bob", "e")),
        "two": table("ID int, color string, n string", (1, "green", "7")),
    }


def test_union_relations(people):
    out = op.union_relations(people)
    assert out.columns == ["_source_relation", "id", "name", "n", "color"]
    assert values(out) == [
        ("one", 1, "drew", "pi", None), ("one", 2, "bob", "e", None), ("two", 1, None, "7", "green"),
    ]


def test_union_relations_options(people):
    out = op.union_relations(people, exclude=["NAME"], source_column_name=None)
    assert out.columns == ["id", "n", "color"]
    out = op.union_relations(people, include=["Id"], where="id = 1", column_override={"id": "string"})
    assert values(out) == [("one", "1"), ("two", "1")]
    with pytest.raises(ValueError):
        op.union_relations(people, include=["id"], exclude=["n"])
    with pytest.raises(ValueError):
        op.union_relations(people, include=["nothing"])


def test_union_of_many_tables(spark):
    tables = {f"t{i}": spark.range(i, i + 1) for i in range(37)}
    out = op.union_relations(tables)
    assert sorted(row.id for row in out.collect()) == list(range(37))


def test_column_values(table, spark):
    df = table("field string, side string", *[(c, "left") for c in "abcdef"], *[("g", "right")] * 5)
    assert op.column_values(df, "field", 7, order_by="field") == list("abcdefg")
    assert op.column_values(df, "field", 1, max_records=1) == ["g"]
    assert op.column_values(df, "field", 9, where="side = 'right'") == ["g"]
    assert op.column_values(df, "field", 9, where="side = 'up'", default=["z"]) == ["z"]
    assert op.column_values("no_such_table", "field", 9, default=["y", "z"]) == ["y", "z"]
    with pytest.raises(ValueError):
        op.column_values("no_such_table", "field", 9)
    with pytest.raises(op.results.ResultTooLarge):
        op.column_values(df, "field", max_rows=3)
    braces = op.column_values(df, "concat(field, '{x}')", 9, where="field <> '{x}' and side = 'right'")
    assert braces == ["g{x}"]


def test_single_value(table, spark):
    df = table("id int, di int", (1, 4), (2, 5), (3, 6))
    assert op.single_value(df.agg(F.min("id"))) == 1
    assert op.single_value(df.agg(F.max("di"))) == 6
    assert op.single_value(df.where("false"), default=1.23456) == 1.23456
    assert op.single_value(spark.sql("select timestamp '2017-01-01 00:00:00'")) == datetime(2017, 1, 1)


def test_results_as_dict(table):
    df = table("col_1 int, col_2 string, col_3 boolean", (1, "a", True), (2, "b", False), (3, "c", None))
    assert op.results_as_dict(df.orderBy("col_1"), max_rows=3) == {
        "col_1": (1, 2, 3), "col_2": ("a", "b", "c"), "col_3": (True, False, None),
    }
    with pytest.raises(op.results.ResultTooLarge):
        op.results_as_dict(df, max_rows=2)


def test_generate_series(spark):
    assert values(op.generate_series(spark, 10).agg(F.sum("generated_number"))) == [(55,)]
    for bound in (0, -3):
        with pytest.raises(ValueError):
            op.generate_series(spark, bound)


def test_date_spine(spark):
    days = op.date_spine(spark, "day", "2018-01-01", "2018-01-10")
    assert days.columns == ["date_day"]
    assert values(days) == [(date(2018, 1, d),) for d in range(1, 10)]
    months = op.date_spine(spark, "month", date(2024, 1, 31), date(2024, 4, 1))
    assert values(months) == [(date(2024, 1, 31),), (date(2024, 2, 29),), (date(2024, 3, 31),)]
    hours = op.date_spine(spark, "hour", "2024-01-01 00:00:00", "2024-01-01 03:00:00")
    assert values(hours) == [(datetime(2024, 1, 1, h),) for h in range(3)]
    with pytest.raises(ValueError):
        op.date_spine(spark, "day", "2018-01-01", "2018-01-01")
    with pytest.raises(ValueError):
        op.date_spine(spark, "fortnight", "2018-01-01", "2018-02-01")


def test_repeat_rows_in_chunks(table):
    df = table("k string, n bigint", ("a", 25_001), ("b", 1), ("c", 0), ("d", 10_000))
    counts = repeat_rows(df, "n").groupBy("k").count()
    assert values(counts) == [("a", 25_001), ("b", 1), ("d", 10_000)]


def test_copies_of_one_row_are_written_by_several_tasks(table):
    rows = repeat_rows(table("k string, n bigint", ("a", 1_000_000)), "n")
    shares = rows.groupBy(F.spark_partition_id()).count().collect()
    assert sum(row["count"] for row in shares) == 1_000_000
    assert max(row["count"] for row in shares) < 500_000
