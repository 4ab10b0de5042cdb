"""Events to sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.functions import surrogate_key_sql, total_sql
from tributary.plans.events import SESSION
from tributary.plans.stages import STAGES, had

# Event column of the earliest event -> session column.
FIRST_TOUCH = {
    "event_date": "session_date",
    "traffic_source": "attributed_source",
    "traffic_medium": "attributed_medium",
    "campaign_name": "attributed_campaign",
    "device_category": "device_category",
    "country": "country",
}


def build_sessions(events: DataFrame, money_type: str | None = None) -> DataFrame:
    """One row for each session, with first-touch attribution, stage flags and revenue.

    Everything about a session comes from one aggregation and so from one shuffle:

    * The first event is the smallest struct that begins with the time, which
      replaces a window, a DISTINCT and a join. NULLs of the first event stay
      NULL; events at the same instant are told apart by their attributes, so a
      re-run gives the same answer.
    * The seven flags travel as bits of one number.
    * Rows are grouped by the two columns the session key is made of. The key
      itself is hashed once for each session, not for each event.

    Partial results are built before the shuffle, so a user who owns a third of
    all events sends one row from each input task. Text in the aggregation buffer makes
    it a sort aggregation, which was still the fastest form measured.

    ``money_type`` names a fixed-point type in which revenue is added up exactly
    (see ``exact_sum``); without it doubles are added as they are.
    """
    rolled_up = events.groupBy(*SESSION).agg(*[F.expr(text) for text in _sums(money_type)])
    return rolled_up.selectExpr(*_columns())


def sessions_sql(source: str, money_type: str | None = None) -> str:
    """The same as a SELECT over a table of events, given as SQL text."""
    sums, keys = ", ".join(_sums(money_type)), ", ".join(SESSION)
    return f"select {', '.join(_columns())} from (select {keys}, {sums} from {source} group by {keys})"


def _sums(money_type: str | None) -> list[str]:
    bits = " ".join(f"when '{stage}' then {1 << i}" for i, stage in enumerate(STAGES))
    return [
        f"min(struct(event_timestamp, {', '.join(FIRST_TOUCH)})) as first",
        "min(event_timestamp) as session_start_at",
        "max(event_timestamp) as session_end_at",
        f"bit_or(case event_name {bits} else 0 end) as stages",
        f"{total_sql('purchase_revenue', money_type)} as revenue",
        "max(transaction_id) as transaction_id",
        "bool_or(session_engaged = '1') as engaged",
        "count(*) as total_events",
    ]


def _columns() -> list[str]:
    touch = [f"first.{source} as {name}" for source, name in FIRST_TOUCH.items()]
    flags = [f"stages & {1 << i} <> 0 as {had(stage)}" for i, stage in enumerate(STAGES)]
    return [
        f"{surrogate_key_sql(SESSION)} as session_id",
        "user_pseudo_id",
        touch[0],
        "session_start_at",
        "session_end_at",
        "timestampdiff(SECOND, session_start_at, session_end_at) as session_duration_seconds",
        *touch[1:],
        *flags,
        "coalesce(revenue, 0D) as session_revenue",
        "transaction_id",
        "coalesce(engaged, false) as is_engaged_session",
        "total_events",
    ]
