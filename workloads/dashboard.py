"""Report queries over the funnel summary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.plans import reports
from workloads import models
from workloads.models import MONEY, SUMMARY_SQL
from workloads.registry import query

_DAY = "CAST(session_date AS VARCHAR) AS session_date"
_MONEY = "CAST(sum(CAST(total_revenue AS DECIMAL(18,2))) AS DOUBLE)"


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    """Means of doubles depend on the order of the rows in their last digits."""
    return df.withColumns({name: F.round(name, 6) for name in names})


@query(
    "dash_filtered",
    f"""{SUMMARY_SQL}
    SELECT * EXCLUDE (session_date, sessions_with_page_view), {_DAY} FROM summary
    WHERE session_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'
      AND channel_group IN ('Organic Search', 'Paid Search', 'Email', 'Direct', 'Paid Social',
                            'Referral', 'Other')
      AND device_category IN ('desktop', 'mobile')""",
)
def dash_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = reports.load_summary(
        models.stored_summary(spark, sf_dir), "2024-01-05", "2024-01-20", reports.DEFAULT_CHANNELS
    )
    return reports.filter_summary(loaded, devices=["desktop", "mobile"])


@query(
    "dash_kpis",
    f"""{SUMMARY_SQL}
    SELECT CAST(sum(total_sessions) AS BIGINT) AS total_sessions,
      CAST(sum(sessions_with_purchase) AS BIGINT) AS total_purchases,
      {_MONEY} AS total_revenue,
      round(avg(avg_order_value), 6) AS avg_order_value,
      CAST(sum(sessions_with_purchase) AS BIGINT) / CAST(sum(total_sessions) AS BIGINT)
        AS conversion_rate
    FROM summary""",
)
def dash_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(reports.kpis(models.stored_summary(spark, sf_dir), MONEY), "avg_order_value")


# Stage labels and their counts, in display order.
_FUNNEL_ROWS = (
    ("Sessions", "total_sessions"),
    ("Viewed product", "sessions_with_view_item"),
    ("Added to cart", "sessions_with_add_to_cart"),
    ("Began checkout", "sessions_with_checkout"),
    ("Entered payment", "sessions_with_payment"),
    ("Purchased", "sessions_with_purchase"),
)


@query(
    "dash_funnel",
    SUMMARY_SQL
    + " UNION ALL ".join(
        f"""
    SELECT {i} AS "position", '{label}' AS stage, CAST(sum({name}) AS BIGINT) AS sessions,
      CAST(sum({name}) AS BIGINT) / CAST(sum(total_sessions) AS BIGINT) * 100 AS pct_of_first
    FROM summary"""
        for i, (label, name) in enumerate(_FUNNEL_ROWS, start=1)
    ),
)
def dash_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.stage_dropoff(models.stored_summary(spark, sf_dir))


@query(
    "dash_daily_cvr",
    f"""{SUMMARY_SQL}
    SELECT {_DAY}, CAST(sum(total_sessions) AS BIGINT) AS sessions,
      CAST(sum(sessions_with_purchase) AS BIGINT) AS purchases,
      round_even(CAST(sum(sessions_with_purchase) AS BIGINT)
        / CAST(sum(total_sessions) AS BIGINT) * 100, 2) AS conversion_rate_pct
    FROM summary GROUP BY summary.session_date""",
)
def dash_daily_cvr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.daily_conversion(models.stored_summary(spark, sf_dir))


@query(
    "dash_revenue_by_channel",
    f"""{SUMMARY_SQL}
    SELECT channel_group, {_MONEY} AS total_revenue FROM summary GROUP BY channel_group""",
)
def dash_revenue_by_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.revenue_by_channel(models.stored_summary(spark, sf_dir), MONEY)


@query(
    "dash_sessions_trend",
    f"""{SUMMARY_SQL}
    SELECT {_DAY}, channel_group, CAST(sum(total_sessions) AS BIGINT) AS total_sessions
    FROM summary GROUP BY summary.session_date, channel_group""",
)
def dash_sessions_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.sessions_trend(models.stored_summary(spark, sf_dir))


# Step labels and the rates shown under them, in display order.
_STEP_ROWS = (
    ("View item", "rate_view_item_to_add_to_cart"),
    ("Add to cart", "rate_cart_to_checkout"),
    ("Checkout", "rate_checkout_to_payment"),
    ("Payment", "rate_payment_to_purchase"),
)


@query(
    "dash_step_rates",
    SUMMARY_SQL
    + " UNION ALL ".join(
        f"""
    SELECT {i} AS "position", '{label}' AS step,
      round_even(avg({name}) * 100, 1) AS rate_pct,
      coalesce(avg({name}) * 100 < 60, false) AS is_low
    FROM summary"""
        for i, (label, name) in enumerate(_STEP_ROWS, start=1)
    ),
)
def dash_step_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.step_rates(models.stored_summary(spark, sf_dir))


@query(
    "dash_channel_table",
    f"""{SUMMARY_SQL}
    SELECT channel_group, CAST(sum(total_sessions) AS BIGINT) AS sessions,
      CAST(sum(sessions_with_purchase) AS BIGINT) AS purchases,
      round(avg(overall_conversion_rate), 6) AS avg_conversion_rate,
      round(avg(avg_order_value), 6) AS avg_order_value,
      {_MONEY} AS revenue
    FROM summary GROUP BY channel_group""",
)
def dash_channel_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = reports.channel_table(models.stored_summary(spark, sf_dir), MONEY)
    return _rounded(table, "avg_conversion_rate", "avg_order_value")


@query("dash_channels", f"{SUMMARY_SQL} SELECT DISTINCT channel_group FROM summary")
def dash_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.available_channels(models.stored_summary(spark, sf_dir))
