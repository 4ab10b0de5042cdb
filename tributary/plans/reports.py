"""Report queries over the funnel summary.

They are cheap: the summary is already aggregated, each report is one more small
aggregation of it. Means of rates and order values are plain means over summary
rows, not weighted by sessions, unless a report says otherwise. ``money_type`` names a
fixed-point type in which revenue is added up exactly; without it doubles are added.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.functions import safe_divide, total
from tributary.functions._args import sql_text
from tributary.plans.stages import STAGE_COUNTS, STEP_RATES
from tributary.plans.summary import DIMENSIONS

# Choices offered, and preselected, in the report filters.
DEFAULT_CHANNELS = (
    "Organic Search", "Paid Search", "Email", "Direct", "Paid Social", "Referral", "Other",
)
DEFAULT_DEVICES = ("desktop", "mobile", "tablet")

# Stage labels and their counts, in display order.
FUNNEL_LABELS = {
    "Sessions": "total_sessions",
    "Viewed product": "sessions_with_view_item",
    "Added to cart": "sessions_with_add_to_cart",
    "Began checkout": "sessions_with_checkout",
    "Entered payment": "sessions_with_payment",
    "Purchased": "sessions_with_purchase",
}

# Step labels and the rates shown under them, in display order.
STEP_LABELS = {
    "View item": "rate_view_item_to_add_to_cart",
    "Add to cart": "rate_cart_to_checkout",
    "Checkout": "rate_checkout_to_payment",
    "Payment": "rate_payment_to_purchase",
}
LOW_RATE = 60

REPORT_COLUMNS = (
    *DIMENSIONS,
    "total_sessions",
    *[name for name in STAGE_COUNTS.values() if name != "sessions_with_page_view"],
    *[name for name, _, _ in STEP_RATES],
    "total_revenue",
    "avg_order_value",
    "engaged_sessions",
    "engagement_rate",
    "avg_session_duration_seconds",
)


def filter_summary(
    summary: DataFrame,
    start_date=None,
    end_date=None,
    channels: Sequence[str] = (),
    devices: Sequence[str] = (),
) -> DataFrame:
    """Rows of a date range (both ends included), of some channels and devices.

    An empty list, or a date left out, means no restriction.
    """
    rows = summary
    if start_date is not None:
        rows = rows.where(F.col("session_date") >= F.lit(start_date).cast("date"))
    if end_date is not None:
        rows = rows.where(F.col("session_date") <= F.lit(end_date).cast("date"))
    if channels:
        rows = rows.where(F.col("channel_group").isin(list(channels)))
    if devices:
        rows = rows.where(F.col("device_category").isin(list(devices)))
    return rows


def load_summary(
    summary: DataFrame, start_date, end_date, channels: Sequence[str] = ()
) -> DataFrame:
    """The columns reports need, of a date range and some channels, ordered by date."""
    rows = filter_summary(summary, start_date, end_date, channels)
    return rows.select(*REPORT_COLUMNS).orderBy("session_date")


def available_channels(summary: DataFrame) -> DataFrame:
    """Channels that occur, in order."""
    return summary.select("channel_group").distinct().orderBy("channel_group")


def kpis(summary: DataFrame, money_type: str | None = None) -> DataFrame:
    """One row: sessions, purchases, overall conversion rate, revenue, mean order value."""
    totals = summary.agg(
        F.coalesce(F.sum("total_sessions"), F.lit(0)).alias("total_sessions"),
        F.coalesce(F.sum("sessions_with_purchase"), F.lit(0)).alias("total_purchases"),
        F.coalesce(total("total_revenue", money_type), F.lit(0.0)).alias("total_revenue"),
        F.avg("avg_order_value").alias("avg_order_value"),
    )
    rate = F.coalesce(safe_divide("total_purchases", "total_sessions"), F.lit(0.0))
    return totals.withColumn("conversion_rate", rate)


def stage_dropoff(summary: DataFrame) -> DataFrame:
    """``(position, stage, sessions, pct_of_first)`` for the stages shown."""
    first = next(iter(FUNNEL_LABELS.values()))
    stages = ", ".join(
        f"named_struct('position', {position}, 'stage', {sql_text(label)}, 'sessions', {name},"
        f" 'pct_of_first', try_divide({name}, {first}) * 100)"
        for position, (label, name) in enumerate(FUNNEL_LABELS.items(), start=1)
    )
    totals = summary.agg(*[F.expr(f"sum({name}) as {name}") for name in FUNNEL_LABELS.values()])
    return totals.selectExpr(f"inline(array({stages}))")


def daily_conversion(summary: DataFrame) -> DataFrame:
    """Purchases per hundred sessions of each day, to two digits (half to even)."""
    daily = summary.groupBy("session_date").agg(
        F.sum("total_sessions").alias("sessions"),
        F.sum("sessions_with_purchase").alias("purchases"),
    )
    rate = safe_divide("purchases", "sessions") * 100
    return daily.withColumn("conversion_rate_pct", F.bround(rate, 2)).orderBy("session_date")


def revenue_by_channel(summary: DataFrame, money_type: str | None = None) -> DataFrame:
    """Revenue of each channel, smallest first."""
    revenue = total("total_revenue", money_type).alias("total_revenue")
    return summary.groupBy("channel_group").agg(revenue).orderBy("total_revenue", "channel_group")


def sessions_trend(summary: DataFrame) -> DataFrame:
    """Sessions by day and channel."""
    return (
        summary.groupBy("session_date", "channel_group")
        .agg(F.sum("total_sessions").alias("total_sessions"))
        .orderBy("session_date", "channel_group")
    )


def step_rates(summary: DataFrame) -> DataFrame:
    """``(position, step, rate_pct, is_low)``: mean of each step's rate over summary rows.

    Rows without a rate do not count; a rate below 60 % is marked.
    """
    steps = ", ".join(
        f"named_struct('position', {position}, 'step', {sql_text(label)},"
        f" 'rate_pct', bround({name}, 1), 'is_low', coalesce({name} < {LOW_RATE}, false))"
        for position, (label, name) in enumerate(STEP_LABELS.items(), start=1)
    )
    means = summary.agg(*[F.expr(f"avg({name}) * 100 as {name}") for name in STEP_LABELS.values()])
    return means.selectExpr(f"inline(array({steps}))")


def channel_table(summary: DataFrame, money_type: str | None = None) -> DataFrame:
    """Sessions, purchases, mean rate, mean order value and revenue; highest revenue first."""
    table = summary.groupBy("channel_group").agg(
        F.sum("total_sessions").alias("sessions"),
        F.sum("sessions_with_purchase").alias("purchases"),
        F.avg("overall_conversion_rate").alias("avg_conversion_rate"),
        F.avg("avg_order_value").alias("avg_order_value"),
        total("total_revenue", money_type).alias("revenue"),
    )
    return table.orderBy(F.desc("revenue"), "channel_group")


def channel_overview(facts: DataFrame, money_type: str | None = None) -> DataFrame:
    """Sessions, purchases and revenue of each channel, straight from the facts."""
    return facts.groupBy("channel_group").agg(
        F.count(F.lit(1)).alias("sessions"),
        F.count_if("is_converted").alias("purchases"),
        total("session_revenue", money_type).alias("revenue"),
    )
