"""Funnel facts to the summary the reports read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.functions import total_sql
from tributary.plans.stages import STAGE_COUNTS, STEP_RATES, had

DIMENSIONS = (
    "session_date",
    "channel_group",
    "attributed_source",
    "attributed_medium",
    "attributed_campaign",
    "device_category",
    "country",
)


def funnel_summary(facts: DataFrame, money_type: str | None = None) -> DataFrame:
    """Session counts, conversion rates, revenue and engagement by seven dimensions.

    One hash aggregation with partial results before the shuffle; the rates are
    computed from its finished counts. A rate over nothing is NULL. ``money_type`` is as in
    ``build_sessions``.
    """
    sums = [F.expr(text) for text in _sums(money_type)]
    return facts.groupBy(*DIMENSIONS).agg(*sums).selectExpr(*_columns())


def summary_sql(source: str, money_type: str | None = None) -> str:
    """The same as a SELECT over a table of facts, given as SQL text."""
    sums, keys = ", ".join(_sums(money_type)), ", ".join(DIMENSIONS)
    return f"select {', '.join(_columns())} from (select {keys}, {sums} from {source} group by {keys})"


def _sums(money_type: str | None) -> list[str]:
    return [
        "count(*) as total_sessions",
        *[f"count_if({had(stage)}) as {name}" for stage, name in STAGE_COUNTS.items()],
        f"{total_sql('session_revenue', money_type)} as total_revenue",
        "count_if(is_engaged_session) as engaged_sessions",
        "avg(session_duration_seconds) as avg_session_duration_seconds",
    ]


def _columns() -> list[str]:
    return [
        *DIMENSIONS,
        "total_sessions",
        *STAGE_COUNTS.values(),
        *[f"try_divide({reached}, {before}) as {name}" for name, reached, before in STEP_RATES],
        "total_revenue",
        "try_divide(total_revenue, sessions_with_purchase) as avg_order_value",
        "engaged_sessions",
        "try_divide(engaged_sessions, total_sessions) as engagement_rate",
        "avg_session_duration_seconds",
    ]
