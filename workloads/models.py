"""The funnel models over the activity table, and the same models in plain SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tributary.functions.keys import NULL_TEXT
from tributary.plans import (
    build_sessions,
    flatten_events,
    fresh_mart,
    funnel_steps,
    funnel_summary,
    refresh_marts,
)
from tributary.sources import scratch_path, to_event_records
from workloads.registry import table

# Revenue is compared with SQL to the last digit, so it is added up exactly.
MONEY = "decimal(29,9)"


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_event_records(table(spark, sf_dir, "events"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_events(records(spark, sf_dir))


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_sessions(events(spark, sf_dir), MONEY)


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return funnel_steps(sessions(spark, sf_dir))


def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return funnel_summary(facts(spark, sf_dir), MONEY)


# Paths of facts and summary by application and table folder.
_marts: dict[tuple[str, str], tuple[str, str]] = {}


def stored_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary mart of a session and table folder, refreshed when it is an hour old."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _marts:
        _marts[key] = scratch_path(spark, "steps"), scratch_path(spark, "summary")
    steps, target = _marts[key]
    return fresh_mart(
        spark, target,
        lambda: refresh_marts(records(spark, sf_dir), steps, target, money_type=MONEY),
    )


_EVENTS = f"""
rec AS (
  SELECT *, regexp_extract(props, '[0-9]+')::INT AS k FROM events
),
raw AS (
  SELECT
    event_id AS seq, ts, epoch_us(ts) AS us,
    CAST(ts AS DATE) AS event_date,
    CASE event_type
      WHEN 'signup' THEN 'session_start'
      WHEN 'view' THEN CASE WHEN k % 2 = 0 THEN 'page_view' ELSE 'view_item' END
      WHEN 'click' THEN CASE WHEN k % 2 = 0 THEN 'add_to_cart' ELSE 'begin_checkout' END
      WHEN 'error' THEN CASE WHEN k % 3 = 0 THEN 'scroll' ELSE 'add_payment_info' END
      ELSE event_type
    END AS event_name,
    CAST(user_id AS VARCHAR) AS user_pseudo_id,
    CASE WHEN k <> 99 THEN date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) END
      AS ga_session_id,
    CASE WHEN k % 2 = 0 THEN '1' ELSE '0' END AS session_engaged,
    event_type || ' ' || k AS page_title,
    'https://shop.example/' || event_type || '?k=' || k AS page_location,
    ['cpc','cpm','email','organic','referral','(none)','social','(not set)',NULL,'widget']
      [k % 10 + 1] AS traffic_medium,
    ['google','facebook','(direct)','newsletter','partner','bing'][user_id % 6 + 1]
      AS traffic_source,
    ['spring_sale','summer_sale',NULL,'brand'][k % 4 + 1] AS campaign_name,
    ['desktop','mobile','tablet'][user_id % 3 + 1] AS device_category,
    ['Windows','Android','iOS','Macintosh'][user_id % 4 + 1] AS operating_system,
    CAST(user_id % 25 AS VARCHAR) AS country,
    CASE WHEN event_type = 'purchase' THEN CAST(event_id AS VARCHAR) END AS transaction_id,
    CASE WHEN event_type = 'purchase' THEN value END AS purchase_revenue,
    CASE WHEN event_type = 'purchase' THEN value * CAST(0.08 AS DOUBLE) END AS tax_value,
    CASE WHEN event_type = 'purchase' THEN CAST(4.99 AS DOUBLE) END AS shipping_value,
    CASE WHEN event_type = 'purchase' OR (event_type = 'click' AND k % 2 = 0) THEN k % 4 END
      AS item_count
  FROM rec
),
ev AS (
  SELECT
    md5(user_pseudo_id || '-' || coalesce(CAST(ga_session_id AS VARCHAR), '{NULL_TEXT}') || '-'
      || strftime(ts, '%Y-%m-%d %H:%M:%S')
      || CASE WHEN us % 1000000 = 0 THEN ''
              WHEN us % 1000 = 0 THEN strftime(ts, '.%g') ELSE strftime(ts, '.%f') END
      || '+00') AS event_id,
    md5(user_pseudo_id || '-' || coalesce(CAST(ga_session_id AS VARCHAR), '{NULL_TEXT}'))
      AS session_id,
    *
  FROM raw
  WHERE traffic_medium <> '(not set)' AND user_pseudo_id IS NOT NULL
)"""

_SESSIONS = """
attribution AS (
  SELECT DISTINCT ON (session_id) session_id,
    traffic_source AS attributed_source, traffic_medium AS attributed_medium,
    campaign_name AS attributed_campaign, device_category, country,
    event_date AS session_date
  FROM ev ORDER BY session_id, us, seq
),
rollup_ AS (
  SELECT session_id, user_pseudo_id,
    min(ts) AS session_start_at, max(ts) AS session_end_at,
    CAST((max(us) - min(us)) // 1000000 AS BIGINT) AS session_duration_seconds,
    bool_or(event_name = 'session_start') AS had_session_start,
    bool_or(event_name = 'page_view') AS had_page_view,
    bool_or(event_name = 'view_item') AS had_view_item,
    bool_or(event_name = 'add_to_cart') AS had_add_to_cart,
    bool_or(event_name = 'begin_checkout') AS had_begin_checkout,
    bool_or(event_name = 'add_payment_info') AS had_add_payment_info,
    bool_or(event_name = 'purchase') AS had_purchase,
    coalesce(CAST(sum(CAST(purchase_revenue AS DECIMAL(18,2))) AS DOUBLE), 0) AS session_revenue,
    max(transaction_id) AS transaction_id,
    bool_or(session_engaged = '1') AS is_engaged_session,
    count(*) AS total_events
  FROM ev GROUP BY session_id, user_pseudo_id
),
sess AS (
  SELECT * FROM rollup_ JOIN attribution USING (session_id)
)"""

_FACTS = """
facts AS (
  SELECT *,
    CASE
      WHEN lower(attributed_medium) IN ('cpc', 'ppc', 'paid', 'paidsearch') THEN 'Paid Search'
      WHEN lower(attributed_medium) IN ('cpm', 'display', 'banner', 'paid_social')
        OR lower(attributed_source) IN ('facebook', 'instagram', 'twitter', 'linkedin', 'tiktok')
        THEN 'Paid Social'
      WHEN lower(attributed_medium) = 'email' THEN 'Email'
      WHEN lower(attributed_medium) IN ('organic', 'seo')
        OR lower(attributed_source) IN ('google', 'bing', 'yahoo', 'duckduckgo')
        THEN 'Organic Search'
      WHEN lower(attributed_medium) IN ('referral', 'affiliate') THEN 'Referral'
      WHEN lower(attributed_medium) IN ('(none)', 'none')
        OR lower(attributed_source) IN ('(direct)', 'direct') THEN 'Direct'
      WHEN lower(attributed_medium) IN ('social', 'social-network', 'sm') THEN 'Organic Social'
      ELSE 'Other'
    END AS channel_group,
    CASE WHEN had_purchase THEN 7 WHEN had_add_payment_info THEN 6 WHEN had_begin_checkout THEN 5
      WHEN had_add_to_cart THEN 4 WHEN had_view_item THEN 3 WHEN had_page_view THEN 2
      WHEN had_session_start THEN 1 ELSE 0 END AS max_funnel_stage,
    CASE WHEN had_purchase THEN 'purchase' WHEN had_add_payment_info THEN 'add_payment_info'
      WHEN had_begin_checkout THEN 'begin_checkout' WHEN had_add_to_cart THEN 'add_to_cart'
      WHEN had_view_item THEN 'view_item' WHEN had_page_view THEN 'page_view'
      WHEN had_session_start THEN 'session_start' ELSE 'unknown' END AS deepest_stage_name,
    had_purchase AS is_converted,
    (had_session_start AND had_page_view) AS progressed_to_page_view,
    (had_page_view AND had_view_item) AS progressed_to_view_item,
    (had_view_item AND had_add_to_cart) AS progressed_to_add_to_cart,
    (had_add_to_cart AND had_begin_checkout) AS progressed_to_checkout,
    (had_begin_checkout AND had_add_payment_info) AS progressed_to_payment,
    (had_add_payment_info AND had_purchase) AS progressed_to_purchase
  FROM sess
)"""

_SUMMARY = """
summary AS (
  SELECT session_date, channel_group, attributed_source, attributed_medium, attributed_campaign,
    device_category, country,
    count(*) AS total_sessions,
    count(*) FILTER (WHERE had_page_view) AS sessions_with_page_view,
    count(*) FILTER (WHERE had_view_item) AS sessions_with_view_item,
    count(*) FILTER (WHERE had_add_to_cart) AS sessions_with_add_to_cart,
    count(*) FILTER (WHERE had_begin_checkout) AS sessions_with_checkout,
    count(*) FILTER (WHERE had_add_payment_info) AS sessions_with_payment,
    count(*) FILTER (WHERE had_purchase) AS sessions_with_purchase,
    sessions_with_page_view / total_sessions AS rate_session_to_page_view,
    sessions_with_view_item / nullif(sessions_with_page_view, 0) AS rate_page_view_to_view_item,
    sessions_with_add_to_cart / nullif(sessions_with_view_item, 0)
      AS rate_view_item_to_add_to_cart,
    sessions_with_checkout / nullif(sessions_with_add_to_cart, 0) AS rate_cart_to_checkout,
    sessions_with_payment / nullif(sessions_with_checkout, 0) AS rate_checkout_to_payment,
    sessions_with_purchase / nullif(sessions_with_payment, 0) AS rate_payment_to_purchase,
    sessions_with_purchase / total_sessions AS overall_conversion_rate,
    CAST(sum(CAST(session_revenue AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue,
    total_revenue / nullif(sessions_with_purchase, 0) AS avg_order_value,
    count(*) FILTER (WHERE is_engaged_session) AS engaged_sessions,
    engaged_sessions / total_sessions AS engagement_rate,
    avg(session_duration_seconds) AS avg_session_duration_seconds
  FROM facts
  GROUP BY 1, 2, 3, 4, 5, 6, 7
)"""

EVENTS_SQL = f"WITH {_EVENTS}"
SESSIONS_SQL = f"{EVENTS_SQL}, {_SESSIONS}"
FACTS_SQL = f"{SESSIONS_SQL}, {_FACTS}"
SUMMARY_SQL = f"{FACTS_SQL}, {_SUMMARY}"

_TIME = "strftime({0}, '%Y-%m-%d %H:%M:%S.%f') AS {0}"
_DAY = "CAST({0} AS VARCHAR) AS {0}"
SESSION_TIMES_SQL = ", ".join(
    [_DAY.format("session_date"), _TIME.format("session_start_at"), _TIME.format("session_end_at")]
)
