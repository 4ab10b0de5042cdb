"""The models as views of the catalog, which any later session can read."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tributary.operators.columns import quoted
from tributary.plans.events import events_sql
from tributary.plans.funnel import steps_sql
from tributary.plans.sessions import sessions_sql
from tributary.plans.summary import summary_sql

# Names of the views.
EVENTS_VIEW, SESSIONS_VIEW = "stg_events", "stg_sessions"
STEPS_VIEW, SUMMARY_VIEW = "funnel_steps", "funnel_summary"


def create_model_views(
    spark: SparkSession, schema: str, records: str, money_type: str | None = None
) -> dict[str, str]:
    """Creates or replaces the views of events, sessions, steps and summary in a schema.

    ``records`` is SQL text for the table or path of event records. Each view's text is made
    from the expressions that the plans run, and reads the view before it; nothing is
    computed. The catalog keeps the text with the session's settings (time zone, ANSI mode),
    so every reader gets the rows that this session would. Returns the texts by full name.
    """
    inside = quoted(schema)
    texts = {
        f"{inside}.{EVENTS_VIEW}": events_sql(records),
        f"{inside}.{SESSIONS_VIEW}": sessions_sql(f"{inside}.{EVENTS_VIEW}", money_type),
        f"{inside}.{STEPS_VIEW}": steps_sql(f"{inside}.{SESSIONS_VIEW}"),
        f"{inside}.{SUMMARY_VIEW}": summary_sql(f"{inside}.{STEPS_VIEW}", money_type),
    }
    for name, text in texts.items():
        spark.sql(f"create or replace view {name} as {text}")
    return texts
