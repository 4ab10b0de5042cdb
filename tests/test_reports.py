from __future__ import annotations

from datetime import date

import pytest

from tributary.plans import reports
from tests.conftest import values

COLUMNS = (
    "session_date date, channel_group string, attributed_source string, attributed_medium string,"
    " attributed_campaign string, device_category string, country string, total_sessions bigint,"
    " sessions_with_page_view bigint, sessions_with_view_item bigint,"
    " sessions_with_add_to_cart bigint, sessions_with_checkout bigint,"
    " sessions_with_payment bigint, sessions_with_purchase bigint,"
    " rate_session_to_page_view double, rate_page_view_to_view_item double,"
    " rate_view_item_to_add_to_cart double, rate_cart_to_checkout double,"
    " rate_checkout_to_payment double, rate_payment_to_purchase double,"
    " overall_conversion_rate double, total_revenue double, avg_order_value double,"
    " engaged_sessions bigint, engagement_rate double, avg_session_duration_seconds double"
)
D1, D2, D3 = date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3)


def row(day, channel, device, sessions, purchases, revenue, aov, step=None):
    return (
        day, channel, "s", "m", None, device, "c", sessions, sessions, sessions, sessions // 2,
        sessions // 4, purchases, purchases, 1.0, 1.0, step, 0.5, None, 1.0,
        purchases / sessions, revenue, aov, 1, 0.1, 2.0,
    )


@pytest.fixture
def summary(table):
    return table(
        COLUMNS,
        row(D1, "Email", "desktop", 80, 8, 100.0, 12.5, 0.5),
        row(D1, "Direct", "mobile", 10, 0, 0.0, None),
        row(D2, "Email", "tablet", 32, 1, 40.0, 40.0, 0.8),
        row(D3, "Organic Social", "desktop", 8, 4, 60.0, 15.0, 0.4),
    )


def test_filters(summary):
    assert reports.filter_summary(summary).count() == 4
    assert reports.filter_summary(summary, D1, "2024-01-02").count() == 3
    assert reports.filter_summary(summary, D2).count() == 2
    assert reports.filter_summary(summary, channels=["Email"], devices=["tablet"]).count() == 1
    assert reports.filter_summary(summary, channels=[], devices=[]).count() == 4
    assert reports.filter_summary(summary, channels=reports.DEFAULT_CHANNELS).count() == 3


def test_load_summary(summary):
    loaded = reports.load_summary(summary, "2024-01-01", "2024-01-02", ["Email"])
    assert len(loaded.columns) == 25 and "sessions_with_page_view" not in loaded.columns
    assert [r.session_date for r in loaded.collect()] == [D1, D2]


def test_kpis(summary):
    kpis = reports.kpis(summary).head()
    assert (kpis.total_sessions, kpis.total_purchases, kpis.total_revenue) == (130, 13, 200.0)
    assert kpis.conversion_rate == 0.1
    assert kpis.avg_order_value == pytest.approx((12.5 + 40 + 15) / 3)
    empty = reports.kpis(summary.where("false")).head()
    assert (empty.total_sessions, empty.conversion_rate, empty.avg_order_value) == (0, 0.0, None)


def test_stage_dropoff(summary):
    rows = reports.stage_dropoff(summary).orderBy("position").collect()
    assert [r.stage for r in rows] == list(reports.FUNNEL_LABELS)
    assert [r.sessions for r in rows] == [130, 130, 65, 32, 13, 13]
    assert rows[2].pct_of_first == 50.0 and rows[5].pct_of_first == 10.0


def test_daily_conversion_rounds_half_to_even(summary):
    rows = reports.daily_conversion(summary).collect()
    assert [(r.session_date, r.conversion_rate_pct) for r in rows] == [
        (D1, 8.89), (D2, 3.12), (D3, 50.0),
    ]


def test_revenue_and_trend(summary):
    assert [tuple(r) for r in reports.revenue_by_channel(summary).collect()] == [
        ("Direct", 0.0), ("Organic Social", 60.0), ("Email", 140.0),
    ]
    assert [tuple(r) for r in reports.sessions_trend(summary).collect()] == [
        (D1, "Direct", 10), (D1, "Email", 80), (D2, "Email", 32), (D3, "Organic Social", 8),
    ]
    assert values(reports.available_channels(summary)) == [
        ("Direct",), ("Email",), ("Organic Social",),
    ]


def test_step_rates_are_plain_means(summary):
    rows = reports.step_rates(summary).orderBy("position").collect()
    assert [(r.step, r.rate_pct, r.is_low) for r in rows] == [
        ("View item", 56.7, True), ("Add to cart", 50.0, True), ("Checkout", None, False),
        ("Payment", 100.0, False),
    ]


def test_channel_table(summary):
    rows = reports.channel_table(summary).collect()
    assert [r.channel_group for r in rows] == ["Email", "Organic Social", "Direct"]
    email = rows[0]
    assert (email.sessions, email.purchases, email.revenue) == (112, 9, 140.0)
    assert email.avg_conversion_rate == pytest.approx((0.1 + 1 / 32) / 2)
    assert email.avg_order_value == 26.25
    assert rows[2].avg_order_value is None
