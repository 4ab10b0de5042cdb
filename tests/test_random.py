"""Two-table checks and sessions on random rows with a hot key, against plain Python."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tributary import checks
from tributary.plans import build_sessions, flatten_events
from tributary.plans.stages import STAGES
from tributary.sources import EVENT_SCHEMA
from tests.conftest import values
from tests.test_models import event


def key(row):
    return [(v is not None, str(v)) for v in row]


def column(rng, n, span):
    """A third of the values are the same, some are missing."""
    return [
        7 if rng.random() < 0.33 else None if rng.random() < 0.1 else rng.randrange(span)
        for _ in range(n)
    ]


@pytest.fixture(params=range(3))
def two_columns(request, table):
    rng = random.Random(request.param)
    left, right = column(rng, 500, 60), column(rng, 400, 80)
    frames = [
        table("v int", *[(v,) for v in values_]).repartition(5) for values_ in (left, right)
    ]
    return left, right, *frames


def test_cardinality(two_columns):
    left, right, a, b = two_columns
    counts = Counter(left), Counter(right)
    expected = [
        (value, side[value])
        for side, other in (counts, counts[::-1])
        for value in side
        if side[value] != other[value]
    ]
    assert values(checks.cardinality_equality(a, "v", b, "v").rows) == sorted(expected, key=key)


def test_equality(two_columns):
    left, right, a, b = two_columns
    expected = [("a_minus_b", v) for v in set(left) - set(right)]
    expected += [("b_minus_a", v) for v in set(right) - set(left)]
    assert values(checks.equality(a, b).rows) == sorted(expected, key=key)


def test_orphans(two_columns):
    left, right, a, b = two_columns
    known = {v for v in right if v is not None and v != 7}
    expected = [(v, None) for v in left if v is not None and v not in known]
    found = checks.relationships_where(a, "v", b, "v", to_condition="v <> 7").rows
    assert values(found) == sorted(expected, key=key)


def test_row_counts(two_columns):
    left, right, a, b = two_columns
    ours, theirs = Counter(left), Counter(right)
    both = [v for v in ours if v is not None and v in theirs]
    expected = [(v, v, ours[v], theirs[v], abs(ours[v] - theirs[v])) for v in both]
    found = checks.equal_rowcount(a, b, ["v"]).rows.where("diff_count is not null")
    assert values(found) == sorted(expected, key=key)


def test_sequence(two_columns):
    left, _, a, _ = two_columns
    ordered = sorted((v for v in left if v is not None))
    expected = [(v, p) for p, v in zip(ordered, ordered[1:], strict=False) if v != p + 1]
    assert values(checks.sequential_values(a, "v").rows) == sorted(expected, key=key)


def test_sessions_do_not_depend_on_the_order_of_events(spark):
    rng = random.Random(5)
    rows = []
    for i in range(1500):
        # A third of the events come from one user without session ids.
        hot = rng.random() < 0.33
        rows.append(
            event(
                "bot" if hot else f"u{rng.randrange(40)}",
                None if hot else rng.randrange(4),
                i * 1_000_000,
                rng.choice([*STAGES, "scroll"]),
                medium=rng.choice(["cpc", "email", "organic"]),
                source=rng.choice(["google", None, "x"]),
                revenue=rng.choice([None, 0.1, 0.2, 19.99]),
            )
        )
    money = "decimal(29,9)"
    once = build_sessions(flatten_events(spark.createDataFrame(rows, EVENT_SCHEMA)), money)
    rng.shuffle(rows)
    again = build_sessions(
        flatten_events(spark.createDataFrame(rows, EVENT_SCHEMA).repartition(11)), money
    )
    assert values(once) == values(again)
    hot_session = once.where("user_pseudo_id = 'bot'").collect()
    expected = [row for row in rows if row[3] == "bot"]
    (row,) = hot_session
    assert row.total_events == len(expected)
    first = min(expected, key=lambda r: r[1])
    assert (row.attributed_medium, row.attributed_source) == (first[5][0], first[5][1])
    assert row.session_revenue == pytest.approx(sum(r[8][1] or 0 for r in expected))
    assert once.agg(F.sum("total_events")).head()[0] == len(rows)
