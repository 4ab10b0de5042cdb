from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tributary import checks
from tributary.checks import Check, run_checks
from tests.conftest import values


def failures(found):
    """The number a report would show."""
    return run_checks([Check("c", found)]).head()["failures"]


def test_accepted_range(table):
    df = table("id int", (-1,), (11,), (None,))
    assert failures(checks.accepted_range(df, "id", -1, 11)) == 0
    assert failures(checks.accepted_range(df, "id", -2, 11.1, inclusive=False)) == 0
    assert failures(checks.accepted_range(df, "id", -1, 11, inclusive=False)) == 2
    assert failures(checks.accepted_range(df, "id", 0, where="id <> -1")) == 0
    assert values(checks.accepted_range(df, "id", 0).rows) == [(-1,)]
    assert failures(checks.accepted_range(df, "id")) == 0


def test_at_least_one(table):
    df = table("field string, value int", ("a", 1), ("b", None))
    assert failures(checks.at_least_one(df, "field")) == 0
    assert failures(checks.at_least_one(df, "value")) == 0
    assert failures(checks.at_least_one(df, "value", where="field = 'b'")) == 1
    assert values(checks.at_least_one(df, "value", ["field"]).rows) == [("b", 0)]


def test_cardinality_equality(table):
    a = table("same int", (1,), (2,), (3,), (None,))
    b = table("same int, other int", (1, 2), (2, 3), (3, 1), (None, None))
    assert failures(checks.cardinality_equality(a, "same", b, "same")) == 0
    assert failures(checks.cardinality_equality(a, "same", b, "other")) == 0
    c = table("v int", (1,), (1,), (2,), (4,), (None,))
    found = checks.cardinality_equality(a, "same", c, "v").rows
    assert values(found) == [(1, 1), (1, 2), (3, 1), (4, 1)]


def test_equal_rowcount(table):
    a = table("field int", (1,), (1,), (2,))
    b = table("field int", (1,), (1,), (2,), (2,), (3,))
    assert failures(checks.equal_rowcount(a, a)) == 0
    assert failures(checks.equal_rowcount(a, a, ["field"])) == 0
    assert failures(checks.equal_rowcount(a, b)) == 2
    assert values(checks.equal_rowcount(a, b, ["field"]).rows) == [
        (None, 3, None, 1, None), (1, 1, 2, 2, 0), (2, 2, 1, 2, 1),
    ]
    assert failures(checks.equal_rowcount(a, b, ["field"])) == 1
    assert failures(checks.equal_rowcount(a, b, ["field"], strict=True)) == 2


def test_row_counts_of_an_empty_table(table):
    empty, full = table("f int"), table("f int", (1,), (2,))
    assert failures(checks.equal_rowcount(empty, full)) == 0
    assert failures(checks.equal_rowcount(empty, full, strict=True)) == 2
    assert failures(checks.equal_rowcount(empty, empty)) == 0


def test_null_groups_do_not_match(table):
    df = table("f int", (None,), (1,))
    assert values(checks.equal_rowcount(df, df, ["f"]).rows) == [
        (None, None, None, 1, None), (None, None, 1, None, None), (1, 1, 1, 1, 0),
    ]


def test_fewer_rows_than(table):
    small = table("g int, f int", (1, 1), (1, 2), (1, 3))
    large = table("g int, f int", (1, 1), (1, 2), (1, 3), (1, 4))
    assert failures(checks.fewer_rows_than(small, large)) == 0
    assert failures(checks.fewer_rows_than(small, large, ["g"])) == 0
    assert failures(checks.fewer_rows_than(large, small)) == 1
    assert failures(checks.fewer_rows_than(small, small)) == 1
    assert failures(checks.fewer_rows_than(large.union(large), small)) == 5


def test_equality_at_every_precision(table):
    a = table("v double", (1.0000000001,), (1e30,))
    b = table("v double", (1.0000000002,), (1e30,))
    assert failures(checks.equality(a, b, precision=12)) == 2
    assert failures(checks.equality(a, b, precision=9)) == 0
    assert failures(checks.equality(a, b)) == 2
    near = table("v double", (0.6,)), table("v double", (1.4,))
    assert failures(checks.equality(*near, precision=0)) == 0
    c, d = (table("v double", (v,)).selectExpr("cast(v as decimal(20,12)) as v") for v in (1.25, 1.250000001))
    assert failures(checks.equality(c, d, precision=9)) == 2
    assert failures(checks.equality(c, d, precision=8)) == 0
    for precision in (-1, 39):
        with pytest.raises(ValueError, match="precision"):
            checks.equality(a, b, precision=precision)


def test_columns_match_set_finds_what_is_missing_or_too_much(table):
    found = checks.columns_match_set(table("a int, B int, c int", (1, 2, 3)), ["A", "b", "d"])
    assert values(found.rows) == [(None, "d"), ("c", None)]


def test_orphans_have_the_type_of_the_parent_column(table):
    found = checks.relationships_where(
        table("k string", ("7",)), "k", table("id bigint", (1,)), "id"
    )
    assert dict(found.rows.dtypes)["right_id"] == "bigint"


def test_equality(table):
    a = table("col_a int, col_b int, col_c int", (1, 1, 3), (1, 2, 1), (2, 3, 3))
    b = table("col_a int, col_b int, col_c int", (1, 1, 2), (1, 2, 2), (2, 3, 2))
    assert failures(checks.equality(a, a)) == 0
    assert failures(checks.equality(a, b)) == 6
    assert failures(checks.equality(a, b.limit(1))) == 4 + 2
    assert failures(checks.equality(a, b, compare_columns=["col_a", "col_b"])) == 0
    assert failures(checks.equality(a, b, exclude_columns=["COL_C"])) == 0
    assert failures(checks.equality(a, b.drop("col_c"), exclude_columns=["col_c"])) == 0
    with pytest.raises(ValueError):
        checks.equality(a, b.drop("col_c"))
    with pytest.raises(ValueError):
        checks.equality(a, b, compare_columns=["col_a"], exclude_columns=["col_b"])


def test_equality_is_about_sets(table):
    a = table("x int, y string", (1, None), (1, None), (2, "b"))
    b = table("y string, x int", (None, 1), ("b", 2), ("b", 2))
    assert failures(checks.equality(a, b)) == 0
    assert values(checks.equality(a.where("x = 1"), b).rows) == [("b_minus_a", 2, "b")]


def test_equality_precision(table):
    a = table("id string, n double", ("a", 62.3888186), ("b", 23.3959675))
    b = table("id string, n double", ("a", 62.3888187), ("b", 23.3959676))
    assert failures(checks.equality(a, b, precision=4)) == 0
    assert failures(checks.equality(a, b, precision=8)) == 4


def test_expression_is_true(table):
    df = table("col_a double, col_b double", (0.0, 1.0), (1.0, 0.0), (0.5, 0.5), (None, 1.0))
    assert failures(checks.expression_is_true(df, "col_a + col_b = 1")) == 0
    assert failures(checks.expression_is_true(df, "col_a = 0.5")) == 2
    assert failures(checks.expression_is_true(df, "col_a = 0.5", where="col_b = 0.5")) == 0
    assert failures(checks.expression_is_true(df, "+ col_b = 1", column="col_a")) == 0


def test_not_accepted_values(table):
    df = table("city string", ("Barcelona",), ("London",), ("London",))
    assert failures(checks.not_accepted_values(df, "city", ["Madrid", "Berlin"])) == 0
    assert values(checks.not_accepted_values(df, "city", ["London"]).rows) == [("London",)]


def test_accepted_values(table):
    df = table("v string", ("a",), ("b",), ("b",), (None,))
    assert failures(checks.accepted_values(df, "v", ["a", "b"])) == 0
    assert values(checks.accepted_values(df, "v", ["a"]).rows) == [("b", 2)]


def test_not_constant(table):
    df = table("g int, f int", (1, 1), (1, 1), (1, 2), (2, 7), (2, None), (3, None))
    assert failures(checks.not_constant(df, "f")) == 0
    assert failures(checks.not_constant(df, "f", where="g = 2")) == 1
    assert values(checks.not_constant(df, "f", ["g"]).rows) == [(2, 1)]
    assert failures(checks.not_constant(df, "f", where="g = 3")) == 0


def test_not_empty_string(table):
    df = table("s string", ("text",), ("trailing  ",), ("   ",), ("",), (None,))
    assert values(checks.not_empty_string(df, "s").rows) == [("",), ("",)]
    assert failures(checks.not_empty_string(df, "s", trim_whitespace=False)) == 1
    assert failures(checks.not_empty_string(df, "s", where="length(s) > 3")) == 0


def test_not_null_proportion(table):
    filled = [(1, 1), (None, 2), (None, 3), (4, 4), (5, 5), (6, 6), (None, 7), (None, 8),
              (None, None), (10, 10)]
    df = table("point_5 int, point_9 int", *filled)
    assert failures(checks.not_null_proportion(df, "point_5", 0.5, 0.5)) == 0
    assert failures(checks.not_null_proportion(df, "point_9", 0.9)) == 0
    assert failures(checks.not_null_proportion(df, "point_9", 0.91)) == 1
    assert failures(checks.not_null_proportion(df, "point_5", 0, 0.4)) == 1
    assert failures(checks.not_null_proportion(df, "point_5", 0, group_by_columns=["point_9"])) == 0
    assert failures(checks.not_null_proportion(df, "point_5", 1, group_by_columns=["point_9"])) == 5


def test_recency(table):
    now = datetime.now()
    df = table("g int, at timestamp", (1, now - timedelta(hours=23)), (2, now - timedelta(days=3)))
    assert failures(checks.recency(df, "at", "day", 1)) == 0
    assert failures(checks.recency(df, "at", "day", 1, group_by_columns=["g"])) == 1
    as_of = F.lit("2024-01-02 12:00:00").cast("timestamp")
    midnight = table("at timestamp", (datetime(2024, 1, 1),))
    assert failures(checks.recency(midnight, "at", "day", 1, as_of=as_of)) == 1
    by_date = checks.recency(midnight, "at", "day", 1, ignore_time_component=True, as_of=as_of)
    assert failures(by_date) == 0


def test_relationships_where(table):
    child = table("id int", (1,), (2,), (4,), (4,), (4,), (None,))
    parent = table("id int", (1,), (2,), (3,), (2,), (None,))
    assert failures(checks.relationships_where(child, "id", parent, "id", "id <> 4")) == 0
    assert values(checks.relationships_where(child, "id", parent, "id").rows) == [(4, None)] * 3
    hidden = checks.relationships_where(child, "id", parent, "id", to_condition="id > 1")
    assert failures(hidden) == 4


def test_unique_and_not_null(table):
    df = table("a int, b string", (1, "x"), (1, "y"), (None, "y"), (None, "y"))
    assert values(checks.unique(df, "a").rows) == [(1, 2)]
    assert failures(checks.unique(df, "a", where="b = 'x'")) == 0
    assert failures(checks.not_null(df, "a")) == 2
    assert failures(checks.not_null(df, "b")) == 0
    assert values(checks.unique_combination_of_columns(df, ["a", "b"]).rows) == [(None, "y")]
    assert failures(checks.unique_combination_of_columns(df, ["a", "b"], where="a = 1")) == 0


def test_assert_equal(table):
    df = table("a int, b int", (1, 1), (1, 2), (None, 1))
    assert values(checks.assert_equal(df, "a", "b").rows) == [(1, 2)]


def test_columns_match_set(table):
    df = table("id int, Name string", (1, "a"))
    assert failures(checks.columns_match_set(df, ["ID", "name"])) == 0
    assert values(checks.columns_match_set(df, ["id", "color"]).rows) == [
        (None, "color"), ("name", None),
    ]


def test_report_statuses(table):
    df = table("a int", (1,), (None,), (None,))
    other = table("a int", (1,))
    found = checks.not_null(df, "a")
    report = run_checks(
        [
            Check("fails", found),
            Check("warns", found, error_if="> 5", warn_if="> 1"),
            Check("passes", found, error_if="> 5", warn_if="> 2"),
            Check("only warns", found, severity="warn"),
            Check("must find rows", found, error_if="< 1", warn_if="< 0"),
            Check("own metric", found, metric="max(coalesce(a, 9))", error_if="> 9", warn_if="> 9"),
            Check("it's other", checks.not_null(other, "a")),
            Check("grouped", checks.unique(df, "a")),
        ]
    )
    assert report.columns == ["check", "failures", "status"]
    assert values(report) == [
        ("fails", 2, "fail"),
        ("grouped", 0, "pass"),
        ("it's other", 0, "pass"),
        ("must find rows", 2, "pass"),
        ("only warns", 2, "warn"),
        ("own metric", 9, "pass"),
        ("passes", 2, "pass"),
        ("warns", 2, "warn"),
    ]
    with pytest.raises(ValueError):
        run_checks([])


def test_report_reads_a_table_once_for_row_rules(spark):
    df = spark.range(10).selectExpr("id", "id % 3 as a", "id % 5 as b")
    rules = [checks.not_null(df, "a"), checks.not_null(df, "b"), checks.accepted_range(df, "id", 0)]
    report = run_checks([Check(f"r{i}", rule) for i, rule in enumerate(rules)])
    assert report._jdf.queryExecution().executedPlan().toString().count("Range (0, 10") == 1


def test_quoting(table):
    df = table("`my col` int, v string", (1, "a"), (1, "b"), (2, "c"))
    found = checks.unique_combination_of_columns(df, ["my col"], quote_columns=True)
    assert values(found.rows) == [(1,)]
    assert failures(checks.accepted_values(df, "v", ["lower('A')", "'b'", "'c'"], quote=False)) == 0
    assert failures(checks.not_accepted_values(df, "v", ["upper('a')", "'c'"], quote=False)) == 1
