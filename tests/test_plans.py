"""The physical plans stay the ones that scale."""

from __future__ import annotations

import os

import pytest

from tributary import checks, operators
from workloads import QUERIES, models

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_sessions_take_one_shuffle(spark):
    text = plan(models.sessions(spark, SF))
    assert text.count("Exchange") == 1
    assert "Window [" not in text and "Join" not in text
    # rows are combined on both sides of the shuffle, sorted, as the buffer holds text
    assert text.count("SortAggregate(") == 2
    # keys are hashed after the shuffle, once for each session
    assert "md5" not in text.split("Exchange")[1]


def test_facts_add_no_shuffle_and_summary_one(spark):
    assert plan(models.facts(spark, SF)).count("Exchange") == 1
    text = plan(models.summary(spark, SF))
    assert text.count("Exchange") == 2
    assert text.count("HashAggregate(") == 2


def test_dedupe_keeps_one_row_for_each_key_before_the_shuffle(spark):
    lines = spark.read.parquet(f"{SF}/lineitem.parquet")
    text = plan(operators.deduplicate(lines, "l_orderkey", "l_shipdate desc, l_linenumber"))
    assert text.count("WindowGroupLimit") == 2
    assert "Partial" in text.split("Exchange")[1]


def test_two_table_checks_take_one_shuffle(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    customers = spark.read.parquet(f"{SF}/customer.parquet")
    found = checks.cardinality_equality(orders, "o_custkey", customers, "c_custkey")
    assert plan(found.rows).count("Exchange") == 1
    compared = checks.equality(orders, orders.where("o_orderkey > 5"))
    assert plan(compared.rows).count("Exchange") == 1


def test_unpivot_reads_the_table_once(spark):
    parts = spark.read.parquet(f"{SF}/part.parquet")
    assert plan(operators.unpivot(parts, exclude=["p_partkey"])).count("FileScan") == 1


@pytest.mark.parametrize("name", [name for name in QUERIES if name.startswith("dash_")])
def test_reports_read_the_stored_summary(spark, name):
    text = plan(QUERIES[name](spark, SF))
    scans = text.split("FileScan parquet")[1:]
    assert len(scans) == 1 and "summary-" in scans[0] and "events.parquet" not in text
    if name == "dash_filtered":
        days = scans[0].split("PartitionFilters: [")[1].split("]")[0]
        assert "2024-01-05" in days and "2024-01-20" in days


def test_reports_count_violations_without_writing_them_out(spark):
    lines = spark.read.parquet(f"{SF}/lineitem.parquet")
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    for found in (
        checks.sequential_values(lines, "l_linenumber", group_by_columns=["l_suppkey"]),
        checks.mutually_exclusive_ranges(lines, "l_linenumber", "l_linenumber + 1", "l_suppkey"),
        checks.relationships_where(lines, "l_orderkey", orders.where("o_orderkey > 50"), "o_orderkey"),
    ):
        report = checks.run_checks([checks.Check("c", found)])
        text = plan(report)
        assert "sequence(" not in text  # copies are written out from sequences
        assert report.head().failures == found.rows.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_query_multiplies_rows_or_runs_python(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ArrowEval"):
        assert operator not in text
    # no window moves its whole input into one task
    lines = text.splitlines()
    for i, line in enumerate(lines):
        if "Window [" in line:
            assert not any("SinglePartition" in below for below in lines[i + 1 : i + 4])
