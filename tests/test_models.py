"""The funnel models on a small hand-made set of event records."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tributary import checks
from tributary.checks import run_checks
from tributary.functions import surrogate_key
from tributary.plans import (
    build_sessions,
    channel_group,
    flatten_events,
    funnel_steps,
    funnel_summary,
    model_checks,
)
from tributary.plans.stages import STAGES
from tributary.sources import EVENT_SCHEMA
from tests.conftest import values

DAY = 24 * 3600 * 1_000_000
START = 18567 * DAY  # 2020-11-01


def event(user, session, at, name, medium="organic", source="google", campaign="c",
          revenue=None, transaction=None, engaged=None, items=None, device="desktop", country="de",
          day="20201101"):
    params = [("page_title", ("Home", None))]
    if session is not None:
        params.insert(0, ("ga_session_id", (None, session)))
    if engaged is not None:
        params.append(("session_engaged", (engaged, None)))
    return (
        day, START + at, name, user, params, (medium, source, campaign), (device, "Linux"),
        (country,), (transaction, revenue, None, None),
        None if items is None else [(str(i),) for i in range(items)],
    )


SECOND = 1_000_000
RECORDS = [
    # all seven stages in order, engaged; the duration 1.2 s counts as one second
    *[event("all", 1, 900_000 + i * 200_000, stage, revenue=10.1 if stage == "purchase" else None,
            transaction="t1" if stage == "purchase" else None, engaged="0" if i else "1")
      for i, stage in enumerate(STAGES)],
    # skips stages: purchase without payment, checkout without cart
    event("skips", 1, 0, "begin_checkout", "cpc", "facebook"),
    event("skips", 1, SECOND, "purchase", "email", "x", revenue=5.0, transaction="b"),
    event("skips", 1, 2 * SECOND, "purchase", "email", "x", revenue=7.25, transaction="a"),
    # only an unmapped event
    event("unknown", 1, 0, "scroll", "widget", "partner", items=0),
    # dropped: unknown medium, test medium, no user
    event("dropped", 1, 0, "page_view", None),
    event("dropped", 2, 0, "page_view", "(not set)"),
    event(None, 3, 0, "page_view"),
    # no session id: both events share a session; the first campaign is NULL and stays
    event("lost", None, 0, "page_view", "email", "x", campaign=None, items=2),
    event("lost", None, 3 * DAY, "view_item", "cpc", "y", campaign="late", day="20201104"),
    # crosses midnight: the date of the first event counts
    event("night", 1, DAY - SECOND, "session_start"),
    event("night", 1, DAY + SECOND, "page_view", day="20201102"),
    # negative revenue
    event("refund", 1, 0, "purchase", revenue=-1.0, transaction="r"),
]


@pytest.fixture(scope="module")
def events(spark):
    return flatten_events(spark.createDataFrame(RECORDS, EVENT_SCHEMA)).cache()


@pytest.fixture(scope="module")
def sessions(events):
    return build_sessions(events).cache()


@pytest.fixture(scope="module")
def facts(sessions):
    return funnel_steps(sessions)


def session(df, user):
    return df.where(F.col("user_pseudo_id") == user).collect()


def test_events_are_filtered_and_flattened(events):
    assert events.count() == len(RECORDS) - 3
    assert events.where("user_pseudo_id = 'dropped' or user_pseudo_id is null").isEmpty()
    first = events.where("user_pseudo_id = 'lost'").orderBy("event_timestamp").head()
    assert (first.ga_session_id, first.session_engaged, first.page_title) == (None, None, "Home")
    assert (first.page_location, first.item_count, first.campaign_name) == (None, 2, None)
    assert first.event_date == date(2020, 11, 1)
    scroll = events.where("event_name = 'scroll'").head()
    assert scroll.item_count == 0
    assert events.where("event_name = 'page_view' and item_count is null").count() == 2


def test_event_keys(events):
    expected = surrogate_key([F.lit("night"), F.lit(1), F.lit("2020-11-01 23:59:59+00")])
    first = events.where("user_pseudo_id = 'night' and event_name = 'session_start'")
    row = first.select("event_id", expected.alias("expected")).head()
    assert row.event_id == row.expected


def test_session_keys_are_unique_and_known(sessions, events):
    assert sessions.count() == sessions.select("session_id").distinct().count() == 6
    assert values(sessions.select("session_id")) == values(events.select("session_id").distinct())


def test_all_stages(facts):
    (row,) = session(facts, "all")
    assert row.max_funnel_stage == 7 and row.deepest_stage_name == "purchase"
    assert all(row[f"had_{stage}"] for stage in STAGES)
    assert row.is_converted and row.progressed_to_purchase and row.progressed_to_checkout
    assert row.session_duration_seconds == 1
    assert (row.session_revenue, row.transaction_id, row.total_events) == (10.1, "t1", 7)
    assert row.is_engaged_session


def test_skipped_stages(facts):
    (row,) = session(facts, "skips")
    assert row.max_funnel_stage == 7
    assert not row.had_add_to_cart and not row.had_add_payment_info
    assert not row.progressed_to_checkout and not row.progressed_to_purchase
    assert (row.session_revenue, row.transaction_id) == (12.25, "b")
    assert (row.attributed_medium, row.attributed_source) == ("cpc", "facebook")
    assert row.channel_group == "Paid Search"


def test_unmapped_events(facts):
    (row,) = session(facts, "unknown")
    assert (row.max_funnel_stage, row.deepest_stage_name) == (0, "unknown")
    assert (row.session_revenue, row.is_engaged_session, row.channel_group) == (0.0, False, "Other")


def test_first_touch_keeps_nulls_and_joins_events_without_session_id(facts):
    (row,) = session(facts, "lost")
    assert row.total_events == 2
    assert row.attributed_campaign is None
    assert (row.attributed_medium, row.session_date) == ("email", date(2020, 11, 1))
    assert row.session_duration_seconds == 3 * 24 * 3600


def test_session_over_midnight(facts):
    (row,) = session(facts, "night")
    assert row.session_date == date(2020, 11, 1)
    assert row.session_end_at == datetime(2020, 11, 2, 0, 0, 1)


def test_first_touch_on_ties_is_stable(spark):
    tied = [event("t", 1, 0, "page_view", source=s) for s in ("b", "a", "c")]
    for order in (tied, tied[::-1]):
        built = build_sessions(flatten_events(spark.createDataFrame(order, EVENT_SCHEMA)))
        assert built.head().attributed_source == "a"


def test_load_time_is_optional(sessions):
    assert "loaded_at" not in funnel_steps(sessions).columns
    assert funnel_steps(sessions, with_load_time=True).columns[-1] == "loaded_at"


# Fixed values: (medium, source, channel), rules that compete among them.
CHANNEL_CASES = [
    ("CPC", "facebook", "Paid Search"), ("ppc", "x", "Paid Search"), ("paid", None, "Paid Search"),
    ("paidsearch", "x", "Paid Search"), ("cpm", "google", "Paid Social"),
    ("display", "x", "Paid Social"), ("banner", "x", "Paid Social"),
    ("paid_social", "x", "Paid Social"), ("email", "facebook", "Paid Social"),
    ("referral", "TikTok", "Paid Social"), (None, "linkedin", "Paid Social"),
    ("Email", "google", "Email"), ("organic", "x", "Organic Search"), ("seo", "x", "Organic Search"),
    ("referral", "google", "Organic Search"), ("(none)", "bing", "Organic Search"),
    ("x", "duckduckgo", "Organic Search"), ("referral", "x", "Referral"),
    ("affiliate", "direct", "Referral"), ("(none)", "x", "Direct"), ("none", None, "Direct"),
    ("social", "(direct)", "Direct"), ("x", "direct", "Direct"), ("social", "x", "Organic Social"),
    ("social-network", "x", "Organic Social"), ("sm", "x", "Organic Social"),
    ("widget", "partner", "Other"), (None, None, "Other"),
]


def test_channels(table):
    df = table("m string, s string, expected string", *CHANNEL_CASES)
    rows = df.select("*", channel_group("m", "s").alias("channel")).collect()
    assert [(row.m, row.s, row.channel) for row in rows] == CHANNEL_CASES


def test_summary(facts):
    rows = funnel_summary(facts).where("attributed_medium = 'organic'").collect()
    (row,) = rows
    assert (row.total_sessions, row.sessions_with_page_view, row.sessions_with_purchase) == (3, 2, 2)
    assert row.rate_session_to_page_view == 2 / 3
    assert row.rate_cart_to_checkout == 1.0
    assert row.rate_payment_to_purchase == 2.0
    assert (row.total_revenue, row.avg_order_value) == (9.1, 4.55)
    assert (row.engaged_sessions, row.avg_session_duration_seconds) == (1, 1.0)
    (other,) = funnel_summary(facts).where("channel_group = 'Other'").collect()
    assert other.rate_page_view_to_view_item is None and other.avg_order_value is None


def test_funnel_order(facts):
    found = checks.funnel_order(facts).rows.join(facts, "session_id")
    assert values(found, "user_pseudo_id", "violation_type") == [
        ("refund", "negative_revenue_on_purchase"),
        ("refund", "purchase_without_payment"),
        ("skips", "checkout_without_cart"),
        ("skips", "purchase_without_payment"),
    ]


def test_declared_checks(events, sessions, facts):
    report = run_checks(model_checks(events, sessions, facts, funnel_summary(facts)))
    failed = report.where("status <> 'pass'")
    assert values(failed, "check", "failures") == [
        ("accepted_values_steps_deepest_stage_name", 1),
        ("accepted_values_steps_max_funnel_stage", 1),
        ("funnel_order", 4),
    ]
    assert report.count() == 26
