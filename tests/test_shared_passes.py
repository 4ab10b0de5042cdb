"""Checks that share work: grouping sets, digests of buckets, counts from footers."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tributary import checks
from tributary.checks import Check, run_checks
from tributary.plans import funnel_steps, funnel_summary, model_checks
from tributary.sources import read_footers, stored
from tests.conftest import values
from workloads import models

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rules(df):
    return {
        "unique": checks.unique(df, "k"),
        "unique pair": checks.unique_combination_of_columns(df, ["k", "g"]),
        "accepted": checks.accepted_values(df, "g", ["a", "b"]),
        "accepted expression": checks.accepted_values(df, "upper(g)", ["'A'"], quote=False),
        "not accepted": checks.not_accepted_values(df, "g", ["c"]),
        "at least one": checks.at_least_one(df, "v", ["g"]),
        "constant": checks.not_constant(df, "v", ["g"]),
        "constant table": checks.not_constant(df, "v"),
        "share": checks.not_null_proportion(df, "v", 0.5, 0.9, ["g"]),
        "share of table": checks.not_null_proportion(df, "v", 0.99),
        "recent": checks.recency(df, "t", "day", 3, group_by_columns=["g"], as_of=F.lit("2024-01-10").cast("timestamp")),
        "recent table": checks.recency(df, "t", "day", 3, as_of=F.lit("2024-03-10").cast("timestamp")),
        "some rows": checks.unique(df, "k", where="g = 'a'"),
        "row": checks.not_null(df, "v"),
        "row where": checks.accepted_range(df, "v", 2, where="g = 'a'"),
    }


@pytest.mark.parametrize("n", [0, 1, 40])
def test_a_shared_pass_counts_like_single_ones(spark, n):
    rng = random.Random(n)
    pick = lambda *items: rng.choice(items)
    rows = [(pick(None, *range(15)), pick("a", "b", "c", None), pick(None, 1, 1, 2), pick(1, 5, 9)) for _ in range(n)]
    df = spark.createDataFrame(rows, "k int, g string, v int, d int").withColumn(
        "t", F.expr("timestamp'2024-01-01' + make_dt_interval(d)")
    )
    found = rules(df)
    report = {r["check"]: r.failures for r in run_checks([Check(c, v) for c, v in found.items()]).collect()}
    assert report == {name: rule.rows.count() for name, rule in found.items()}


def test_a_shared_pass_reads_and_shuffles_once(spark):
    df = spark.range(50).selectExpr("id as k", "id % 3 as g", "id as v", "timestamp'2024-01-01' as t")
    found = rules(df.withColumn("g", F.expr("cast(g as string)")))
    del found["some rows"]
    text = plan(run_checks([Check(c, v) for c, v in found.items()]))
    assert text.count("Range (0, 50") == 1
    assert text.count("Expand") == 1
    assert text.count("Exchange hashpartitioning") == 1


def test_the_report_reads_each_model_once(spark):
    events = models.events(spark, SF)
    sessions = stored(models.sessions(spark, SF), "sessions")
    steps = stored(funnel_steps(sessions), "steps")
    summary = stored(funnel_summary(steps, models.MONEY), "summary")
    report = run_checks(model_checks(events, sessions, steps, summary))
    assert plan(report).count("FileScan parquet") == 4
    assert report.count() == 26


def digest_pairs(spark):
    nested = "struct(if(id % 7 = 0, null, id) as a, array(id, null) as b)"
    base = spark.range(500).selectExpr(
        "cast(id % 400 as int) as i", "if(id % 5 = 0, null, concat('x', id % 400)) as s",
        f"if(id % 400 = 3, 0D, id % 400 / 3) as d", f"{nested.replace('id', '(id % 400)')} as n",
    )
    return {
        "equal": (base, base),
        "repeats": (base, base.union(base.limit(20))),
        "negative zero": (base, base.withColumn("d", F.expr("if(i = 3, -0D, d)"))),
        "nulls moved": (base, base.withColumn("s", F.expr("if(i = 8, null, s)"))),
        "rows less": (base.where("i <> 17"), base.where("i <> 18")),
        "nested": (base, base.withColumn("n", F.expr("if(i = 9, struct(n.a as a, array(0L) as b), n)"))),
        "empty": (base.limit(0), base),
        "nan": (base, base.withColumn("d", F.expr("if(i < 3, double('nan'), d)"))),
        "precision": (base, base.withColumn("d", F.col("d") + F.expr("if(i = 4, 0.2, 0.00001)"))),
    }


def test_digests_find_the_rows_that_a_full_comparison_finds(spark):
    for name, (left, right) in digest_pairs(spark).items():
        args = {"precision": 3} if name == "precision" else {}
        plain = checks.equality(left, right, **args)
        fast = checks.equality(left, right, by_digests=True, **args)
        assert sorted(map(repr, fast.rows.collect())) == sorted(map(repr, plain.rows.collect())), name
        assert (plain.rows.count() == 0) == (name in ("equal", "repeats", "negative zero"))


def test_equal_tables_shuffle_digests_alone(spark):
    lines = spark.read.parquet(f"{SF}/lineitem.parquet")
    found = checks.equality(lines, lines.repartition(3), by_digests=True).rows
    assert found.count() == 0
    other = lines.withColumn("l_tax", F.expr("if(l_orderkey = 1, -1, l_tax)"))
    found = checks.equality(lines, other, by_digests=True, where="l_linenumber < 9")
    changed = lines.where("l_orderkey = 1").count()
    assert found.rows.count() == 2 * changed > 0
    text = plan(found.rows)
    assert "BroadcastHashJoin" in text and text.count("LeftSemi") == 2


def test_counts_and_ends_come_from_footers(spark):
    orders, lines = (read_footers(spark, f"{SF}/{name}.parquet") for name in ("orders", "lineitem"))
    for found in (checks.equal_rowcount(orders, lines), checks.fewer_rows_than(lines, orders)):
        assert plan(found.rows).count("PushedAggregation: [COUNT(*)]") == 2
    newest = orders.agg(F.max("o_orderkey"), F.min("o_orderkey"), F.count("o_custkey"))
    text = plan(newest)
    assert "PushedAggregation: [MAX(o_orderkey), MIN(o_orderkey), COUNT(o_custkey)]" in text
    plain = spark.read.parquet(f"{SF}/orders.parquet")
    assert newest.collect() == plain.agg(F.max("o_orderkey"), F.min("o_orderkey"), F.count("o_custkey")).collect()
    # A filter, or a time, needs the rows.
    filtered = checks.equal_rowcount(orders, lines, where="o_custkey > 5")
    assert plan(filtered.rows).count("PushedAggregation: [COUNT(*)]") == 1
    assert filtered.rows.head()["count_a"] == plain.where("o_custkey > 5").count()
    latest = orders.agg(F.max("o_orderdate"))
    assert "PushedAggregation: []" in plan(latest)
    assert latest.collect() == plain.agg(F.max("o_orderdate")).collect()
    # The next table is read as tables always are.
    assert "FileScan parquet" in plan(spark.read.parquet(f"{SF}/orders.parquet"))


def test_newest_day_of_a_table_comes_from_footers(spark, tmp_path):
    days = spark.range(900).selectExpr("date_add(date'2024-01-01', cast(id % 30 as int)) as day", "id")
    days.write.parquet(str(tmp_path / "days"))
    rows = read_footers(spark, str(tmp_path / "days"))
    old = checks.recency(rows, "day", "day", 2, as_of=F.lit("2024-02-10").cast("timestamp"), ignore_time_component=True)
    assert "PushedAggregation: [MAX(day)]" in plan(old.rows)
    assert old.rows.count() == 1


def test_ungrouped_counts_of_empty_tables(spark):
    some, none = spark.range(3), spark.range(0)
    assert values(checks.equal_rowcount(some, none).rows) == [(3, None, None)]
    assert values(checks.equal_rowcount(some, none, strict=True).rows) == [(3, 0, 3)]
    assert checks.equal_rowcount(none, none).rows.count() == 0
