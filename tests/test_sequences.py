"""Checks about neighbouring rows, against a plain Python rendering of the rules."""

from __future__ import annotations

import random
from datetime import datetime

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tributary import checks
from tributary.operators.ordering import neighbours
from tests.conftest import values


def count(found):
    return found.rows.count()


def test_sequential_values(table):
    df = table("g int, v int", (1, 2), (1, 4), (1, 6), (2, 8), (2, 10))
    assert count(checks.sequential_values(df, "v", 2)) == 0
    assert count(checks.sequential_values(df, "v", 2, group_by_columns=["g"])) == 0
    assert values(checks.sequential_values(df, "v").rows) == [(10, 8), (4, 2), (6, 4), (8, 6)]
    found = checks.sequential_values(df, "v", group_by_columns=["g"]).rows
    assert found.columns == ["g", "v", "previous_v"]
    assert values(found) == [(1, 4, 2), (1, 6, 4), (2, 10, 8)]


def test_sequential_timestamps(table):
    hours = [(datetime(2021, 1, 1, h),) for h in (0, 1, 2, 3)]
    df = table("at timestamp", *hours)
    assert count(checks.sequential_values(df, "at", 1, "hour")) == 0
    gap = table("at timestamp", *hours, (datetime(2021, 1, 1, 5),))
    assert values(checks.sequential_values(gap, "at", 1, "hour").rows) == [
        (datetime(2021, 1, 1, 5), datetime(2021, 1, 1, 3))
    ]


def test_sequential_values_with_repeats_and_nulls(table):
    df = table("v int", (None,), (None,), (1,), (1,), (1,), (2,))
    assert values(checks.sequential_values(df, "v").rows) == [(1, 1), (1, 1)]
    assert count(checks.sequential_values(df, "v", where="v is null or v = 2")) == 0


@pytest.mark.parametrize("gaps", ["allowed", "not_allowed", "required"])
def test_ranges_without_groups(table, gaps):
    touching = table("lo int, hi int", (0, 1), (1, 2), (2, 4))
    expected = {"allowed": 0, "not_allowed": 0, "required": 2}[gaps]
    assert count(checks.mutually_exclusive_ranges(touching, "lo", "hi", gaps=gaps)) == expected


def test_ranges_with_groups_and_expressions(table):
    df = table(
        "id int, a string, b string",
        (1, "2019-01-01", "2019-02-01"),
        (1, "2019-03-03", "2019-04-01"),
        (2, "2019-05-06", "2019-07-02"),
        (2, "2019-07-03", None),
    )
    upper = "coalesce(b, '2099-01-01')"
    for gaps in ("allowed", "required"):
        assert count(checks.mutually_exclusive_ranges(df, "a", upper, "id", gaps)) == 0
    assert count(checks.mutually_exclusive_ranges(df, "a", upper, "id", "not_allowed")) == 2
    assert count(checks.mutually_exclusive_ranges(df, "a", "b", "id")) == 1
    with pytest.raises(ValueError):
        checks.mutually_exclusive_ranges(df, "a", "b", gaps="maybe")


def test_ranges_of_zero_length(table):
    df = table(
        "id int, a string, b string",
        (3, "2020-05-06", "2020-05-07"),
        (3, "2020-05-08", "2020-05-10"),
        (3, "2020-05-08", "2020-05-08"),
        (3, "2020-05-12", "2020-05-15"),
        (4, "2020-06-06", "2020-06-07"),
        (4, "2020-06-08", "2020-06-08"),
        (4, "2020-06-09", "2020-06-10"),
    )
    allowed = checks.mutually_exclusive_ranges(df, "a", "b", "id", zero_length_range_allowed=True)
    assert count(allowed) == 0
    assert count(checks.mutually_exclusive_ranges(df, "a", "b", "id")) == 2


def _broken_ranges(rows):
    """Brute force: (group, lower, upper) rows to the broken ones with their successor."""
    out = []
    for group in sorted({row[0] for row in rows}):
        ordered = sorted((lo, hi) for g, lo, hi in rows if g == group)
        for i, (lo, hi) in enumerate(ordered):
            last = i == len(ordered) - 1
            following = None if last else ordered[i + 1][0]
            if not (lo < hi and (last or hi <= following)):
                out.append((group, lo, hi, following, last))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_ranges_against_brute_force(table, seed):
    rng = random.Random(seed)
    rows = []
    for _ in range(400):
        # Half of the rows fall into one group, many of them are equal.
        group = 0 if rng.random() < 0.5 else rng.randrange(1, 30)
        low = rng.randrange(0, 40)
        rows.append((group, low, low + rng.randrange(0, 4)))
    df = table("g int, lo int, hi int", *rows).repartition(7)
    found = checks.mutually_exclusive_ranges(df, "lo", "hi", "g").rows.select(
        "partition_by_col", "lower_bound", "upper_bound", "next_lower_bound", "is_last_record"
    )
    assert values(found) == sorted(
        _broken_ranges(rows), key=lambda row: [(v is not None, str(v)) for v in row]
    )


@pytest.mark.parametrize("previous", [True, False])
def test_neighbours_agree_with_a_window_across_slices(spark, previous):
    rng = random.Random(7)
    pairs = {(0 if rng.random() < 0.4 else rng.randrange(1, 50), rng.randrange(500)) for _ in range(3000)}
    df = spark.createDataFrame(sorted(pairs), "g int, v int").repartition(9)
    # Without coalescing the range partitions stay apart, so groups cross slices.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = neighbours(df, ["g"], ["v"], "v", previous, keep=lambda near: F.lit(True))
        got = values(found.select("g", "v", "neighbour.value"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    window = Window.partitionBy("g").orderBy("v")
    shift = F.lag if previous else F.lead
    assert got == values(df.select("g", "v", shift("v").over(window)))


def test_no_task_gets_a_whole_table(spark):
    """Without groups a plain window would move all rows into one partition."""
    df = spark.range(1000)
    plan = checks.sequential_values(df, "id").rows._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    assert "rangepartitioning" in plan
