"""The rules declared for the funnel models."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tributary import checks
from tributary.checks import Check
from tributary.plans.funnel import CHANNEL_NAMES
from tributary.plans.stages import STAGES

NOT_NULL = {
    "events": ("event_id", "session_id", "event_name", "event_timestamp", "user_pseudo_id"),
    "sessions": ("session_id", "user_pseudo_id", "session_date", "had_purchase", "session_revenue"),
    "steps": (
        "session_id", "max_funnel_stage", "deepest_stage_name", "channel_group", "is_converted",
        "session_revenue",
    ),
    "summary": ("session_date", "channel_group", "total_sessions"),
}

# The columns that readers of the summary rely on.
SUMMARY_COLUMNS = (
    "session_date", "channel_group", "attributed_source", "attributed_medium",
    "attributed_campaign", "device_category", "country", "total_sessions",
    "sessions_with_page_view", "sessions_with_view_item", "sessions_with_add_to_cart",
    "sessions_with_checkout", "sessions_with_payment", "sessions_with_purchase",
    "rate_session_to_page_view", "rate_page_view_to_view_item",
    "rate_view_item_to_add_to_cart", "rate_cart_to_checkout", "rate_checkout_to_payment",
    "rate_payment_to_purchase", "overall_conversion_rate", "total_revenue", "avg_order_value",
    "engaged_sessions", "engagement_rate", "avg_session_duration_seconds",
)


def model_checks(
    events: DataFrame, sessions: DataFrame, steps: DataFrame, summary: DataFrame
) -> list[Check]:
    """The rules declared for the four models, to pass to ``run_checks``.

    Three of them are expected to find rows in real traffic: sessions without any
    funnel event have stage 0 with the name ``unknown``, and sessions do skip stages.
    Pass stored sessions and summary, or every check computes them again.
    """
    tables = {"events": events, "sessions": sessions, "steps": steps, "summary": summary}
    rules = [
        Check(f"not_null_{name}_{column}", checks.not_null(tables[name], column))
        for name, columns in NOT_NULL.items()
        for column in columns
    ]
    stages = list(STAGES)
    return [
        *rules,
        Check("unique_sessions_session_id", checks.unique(sessions, "session_id")),
        Check("unique_steps_session_id", checks.unique(steps, "session_id")),
        Check(
            "accepted_values_steps_max_funnel_stage",
            checks.accepted_values(steps, "max_funnel_stage", range(1, len(stages) + 1)),
        ),
        Check(
            "accepted_values_steps_deepest_stage_name",
            checks.accepted_values(steps, "deepest_stage_name", stages),
        ),
        Check(
            "accepted_values_steps_channel_group",
            checks.accepted_values(steps, "channel_group", CHANNEL_NAMES),
        ),
        Check("funnel_order", checks.funnel_order(steps)),
        Check(
            "columns_match_set_summary",
            checks.columns_match_set(summary, SUMMARY_COLUMNS),
        ),
    ]
