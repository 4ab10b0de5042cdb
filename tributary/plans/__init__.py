"""The funnel models, from event records to report tables.

Every plan is a function from DataFrame to DataFrame, so Spark sees the whole
chain as one query and prunes columns and partitions through all of it.
"""

from tributary.plans.events import flatten_events
from tributary.plans.funnel import channel_group, funnel_steps
from tributary.plans.marts import (
    fresh_mart,
    publish_view,
    read_mart,
    refresh_marts,
    summary_schema,
    write_funnel_steps,
    write_funnel_summary,
)
from tributary.plans.model_checks import model_checks
from tributary.plans.sessions import build_sessions
from tributary.plans.summary import funnel_summary
from tributary.plans.views import create_model_views

__all__ = [
    "build_sessions",
    "channel_group",
    "create_model_views",
    "flatten_events",
    "fresh_mart",
    "funnel_steps",
    "funnel_summary",
    "model_checks",
    "publish_view",
    "read_mart",
    "refresh_marts",
    "summary_schema",
    "write_funnel_steps",
    "write_funnel_summary",
]
