"""Event, session and funnel models; stored marts."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.checks import funnel_order
from tributary.functions import total
from tributary.operators.reshape import union_all
from tributary.plans import (
    create_model_views,
    flatten_events,
    fresh_mart,
    publish_view,
    read_mart,
    refresh_marts,
    reports,
)
from tributary.plans.sessions import FIRST_TOUCH
from tributary.plans.views import STEPS_VIEW
from tributary.sources import read_event_tables, read_events, scratch_path, write_event_tables
from workloads import models
from workloads.models import EVENTS_SQL, FACTS_SQL, SESSION_TIMES_SQL, SESSIONS_SQL, SUMMARY_SQL
from workloads.registry import query


@query(
    "channel_overview",
    f"""{FACTS_SQL}
    SELECT channel_group, count(*) AS sessions,
      count(*) FILTER (WHERE is_converted) AS purchases,
      CAST(sum(CAST(session_revenue AS DECIMAL(18,2))) AS DOUBLE) AS revenue
    FROM facts GROUP BY channel_group""",
)
def channel_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.channel_overview(models.facts(spark, sf_dir), models.MONEY)


@query(
    "events_flat",
    f"""{EVENTS_SQL}
    SELECT * EXCLUDE (seq, ts, us, event_date),
      CAST(event_date AS VARCHAR) AS event_date,
      strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS event_timestamp
    FROM ev""",
)
def events_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.events(spark, sf_dir)


@query(
    "event_scan_range",
    f"""{EVENTS_SQL}
    SELECT CAST(event_date AS VARCHAR) AS event_date, event_name, count(*) AS events,
      count(DISTINCT user_pseudo_id) AS users
    FROM ev WHERE event_date BETWEEN DATE '2024-01-08' AND DATE '2024-01-14'
    GROUP BY 1, 2""",
)
def event_scan_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = scratch_path(spark, "events")
    by_day = models.records(spark, sf_dir).hint("rebalance", "event_date")
    by_day.write.partitionBy("event_date").parquet(stored)
    week = flatten_events(read_events(spark, stored, "20240108", "20240114"))
    return week.groupBy("event_date", "event_name").agg(
        F.count(F.lit(1)).alias("events"), F.countDistinct("user_pseudo_id").alias("users")
    )


@query(
    "event_scan_tables",
    f"""{EVENTS_SQL}
    SELECT CAST(event_date AS VARCHAR) AS event_date, traffic_medium, count(*) AS events,
      count(transaction_id) AS transactions
    FROM ev WHERE event_date BETWEEN DATE '2024-01-08' AND DATE '2024-01-14'
    GROUP BY 1, 2""",
)
def event_scan_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily tables of all days, of which seven are read; records change their shape.

    Days of one shape are written by one job.
    """
    schema = f"daily_{uuid4().hex}"
    spark.sql(f"create database {schema} location '{scratch_path(spark, schema)}'")
    records = models.records(spark, sf_dir).where("event_date is not null")
    term = F.col("traffic_source").withField("term", F.lit("x"))
    shapes = {
        "event_date = '20240110'": records.withColumn("traffic_source", term),  # a member more
        "event_date = '20240111'":  # a column less and one more
            records.drop("geo").withColumn("stream_id", F.lit(1)),
        "event_date not in ('20240110', '20240111')": records,
    }
    for days, shape in shapes.items():
        write_event_tables(shape.where(days), schema, scratch_path(spark, "shape"))
    week = flatten_events(read_event_tables(spark, schema, "20240108", "20240114"))
    return week.groupBy("event_date", "traffic_medium").agg(
        F.count(F.lit(1)).alias("events"), F.count("transaction_id").alias("transactions")
    )


@query(
    "marts_refreshed_twice",
    f"""{SUMMARY_SQL}
    SELECT 'before' AS read, CAST(session_date AS VARCHAR) AS session_date,
      CAST(sum(total_sessions) AS BIGINT) AS sessions
    FROM summary WHERE session_date < DATE '2024-01-16' GROUP BY ALL
    UNION ALL
    SELECT 'after', CAST(session_date AS VARCHAR), CAST(sum(total_sessions) AS BIGINT)
    FROM summary GROUP BY ALL""",
)
def marts_refreshed_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart of the first days, read; then one of all days takes its place, while the plan
    made before goes on reading the old files."""
    steps, target = scratch_path(spark, "steps"), scratch_path(spark, "summary")
    records = models.records(spark, sf_dir)
    reads = {}
    for name, rows in {"before": records.where("event_date < '20240116'"), "after": records}.items():
        refresh_marts(rows, steps, target, money_type=models.MONEY)
        reads[name] = read_mart(spark, target)
    before, after = (
        mart.groupBy("session_date").agg(F.sum("total_sessions").alias("sessions"))
        .select(F.lit(name).alias("read"), "session_date", "sessions")
        for name, mart in reads.items()
    )
    return before.unionByName(after)


@query(
    "mart_refreshed_when_old",
    f"""{SUMMARY_SQL},
    first_days AS (
      SELECT CAST(session_date AS VARCHAR) AS session_date, CAST(sum(total_sessions) AS BIGINT)
        AS sessions
      FROM summary WHERE session_date < DATE '2024-01-16' GROUP BY ALL)
    SELECT 'missing' AS read, * FROM first_days
    UNION ALL
    SELECT 'young', * FROM first_days
    UNION ALL
    SELECT 'old', CAST(session_date AS VARCHAR), CAST(sum(total_sessions) AS BIGINT)
    FROM summary GROUP BY ALL""",
)
def mart_refreshed_when_old(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart over a folder of days, to which later days are added after the first read. They
    are not seen while the mart is young, and seen as soon as it counts as old."""
    path = scratch_path(spark, "arriving")
    steps, target = scratch_path(spark, "steps"), scratch_path(spark, "summary")
    records = models.records(spark, sf_dir)

    def refresh() -> None:
        rows = read_events(spark, path, "00000000", "99999999")
        refresh_marts(rows, steps, target, money_type=models.MONEY)

    def arrive(days: str) -> None:
        rows = records.where(days).hint("rebalance", "event_date")
        rows.write.mode("append").partitionBy("event_date").parquet(path)

    arrive("event_date < '20240116'")
    reads = {"missing": fresh_mart(spark, target, refresh)}
    arrive("event_date >= '20240116'")
    reads["young"] = fresh_mart(spark, target, refresh)
    reads["old"] = fresh_mart(spark, target, refresh, max_age=0)
    return union_all([
        mart.groupBy("session_date").agg(F.sum("total_sessions").alias("sessions"))
        .select(F.lit(name).alias("read"), "session_date", "sessions")
        for name, mart in reads.items()
    ])


@query("sessions", f"{SESSIONS_SQL} SELECT * REPLACE ({SESSION_TIMES_SQL}) FROM sess")
def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.sessions(spark, sf_dir)


@query(
    "session_attribution",
    f"""{SESSIONS_SQL}
    SELECT * REPLACE (CAST(session_date AS VARCHAR) AS session_date) FROM attribution""",
)
def session_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.sessions(spark, sf_dir).select("session_id", *FIRST_TOUCH.values())


@query(
    "sessions_view",
    f"""{SESSIONS_SQL}
    SELECT attributed_medium, count(*) AS sessions,
      CAST(sum(total_events) AS BIGINT) AS events
    FROM sess GROUP BY attributed_medium""",
)
def sessions_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    publish_view(models.events(spark, sf_dir), "web_events")
    publish_view(models.sessions(spark, sf_dir), "web_sessions")
    return spark.sql("""
        select attributed_medium, count(*) as sessions, sum(total_events) as events
        from web_sessions group by attributed_medium
    """)


@query(
    "model_views",
    f"""{FACTS_SQL}
    SELECT channel_group, max_funnel_stage, count(*) AS sessions,
      CAST(sum(CAST(session_revenue AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
      CAST(max(session_date) AS VARCHAR) AS last_day
    FROM facts GROUP BY ALL""",
)
def model_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views kept by the catalog, made in this session and read in another."""
    schema, path = f"models_{uuid4().hex}", scratch_path(spark, "records")
    models.records(spark, sf_dir).write.parquet(path)
    spark.sql(f"create database {schema} location '{scratch_path(spark, schema)}'")
    create_model_views(spark, schema, f"parquet.`{path}`", models.MONEY)
    steps = spark.newSession().table(f"{schema}.{STEPS_VIEW}")
    return steps.groupBy("channel_group", "max_funnel_stage").agg(
        F.count(F.lit(1)).alias("sessions"),
        total("session_revenue", models.MONEY).alias("revenue"),
        F.max("session_date").alias("last_day"),
    )


@query("funnel_steps", f"{FACTS_SQL} SELECT * REPLACE ({SESSION_TIMES_SQL}) FROM facts")
def steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.facts(spark, sf_dir)


@query(
    "funnel_summary",
    f"""{SUMMARY_SQL}
    SELECT * REPLACE (CAST(session_date AS VARCHAR) AS session_date) FROM summary""",
)
def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.summary(spark, sf_dir)


_BROKEN = (
    ("checkout_without_cart", "had_begin_checkout AND NOT had_add_to_cart"),
    ("payment_without_checkout", "had_add_payment_info AND NOT had_begin_checkout"),
    ("purchase_without_payment", "had_purchase AND NOT had_add_payment_info"),
    ("negative_revenue_on_purchase", "had_purchase AND session_revenue < 0"),
)


@query(
    "funnel_order_violations",
    FACTS_SQL
    + " UNION ALL ".join(
        f" SELECT session_id, '{name}' AS violation_type FROM facts WHERE {broken}"
        for name, broken in _BROKEN
    ),
)
def funnel_order_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return funnel_order(models.facts(spark, sf_dir)).rows


@query(
    "write_read_marts",
    f"""{SUMMARY_SQL}
    SELECT * EXCLUDE (session_date, sessions_with_page_view),
      CAST(session_date AS VARCHAR) AS session_date
    FROM summary WHERE session_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-19'""",
)
def write_read_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps_path, summary_path = scratch_path(spark, "steps"), scratch_path(spark, "summary")
    refresh_marts(
        models.records(spark, sf_dir), steps_path, summary_path, money_type=models.MONEY
    )
    return reports.load_summary(read_mart(spark, summary_path), "2024-01-10", "2024-01-19")
