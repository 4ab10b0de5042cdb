"""Sessions to funnel facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions._args import sql_list, sql_text
from tributary.plans.stages import PROGRESS_FLAGS, STAGES, UNKNOWN_STAGE, had

# Channels as (name, media, sources). The first channel that lists the
# lower-cased medium or source of a session wins.
CHANNELS = (
    ("Paid Search", ("cpc", "ppc", "paid", "paidsearch"), ()),
    (
        "Paid Social",
        ("cpm", "display", "banner", "paid_social"),
        ("facebook", "instagram", "twitter", "linkedin", "tiktok"),
    ),
    ("Email", ("email",), ()),
    ("Organic Search", ("organic", "seo"), ("google", "bing", "yahoo", "duckduckgo")),
    ("Referral", ("referral", "affiliate"), ()),
    ("Direct", ("(none)", "none"), ("(direct)", "direct")),
    ("Organic Social", ("social", "social-network", "sm"), ()),
)
OTHER_CHANNEL = "Other"
CHANNEL_NAMES = (*[name for name, _, _ in CHANNELS], OTHER_CHANNEL)


def channel_group(medium: str, source: str) -> Column:
    """Marketing channel of a medium and source, given as column names or SQL text."""
    return F.expr(channel_sql(medium, source))


def channel_sql(medium: str, source: str) -> str:
    """SQL text of ``channel_group``."""
    rules = []
    for name, media, sources in CHANNELS:
        listed = f"lower({medium}) in ({sql_list(media)})"
        if sources:
            listed += f" or lower({source}) in ({sql_list(sources)})"
        rules.append(f"when {listed} then {sql_text(name)}")
    return f"case {' '.join(rules)} else {sql_text(OTHER_CHANNEL)} end"


def funnel_steps(sessions: DataFrame, with_load_time: bool = False) -> DataFrame:
    """One row for each session: deepest stage, channel, and step flags.

    The deepest stage may lie below one that was skipped; the step flags only ask
    for a stage and the one right before it. All of it is a projection.
    """
    return sessions.selectExpr(*_columns(with_load_time))


def steps_sql(source: str) -> str:
    """The same as a SELECT over a table of sessions, given as SQL text."""
    return f"select {', '.join(_columns(False))} from {source}"


def _columns(with_load_time: bool) -> list[str]:
    upward = list(enumerate(STAGES, start=1))[::-1]
    numbers = " ".join(f"when {had(stage)} then {number}" for number, stage in upward)
    names = " ".join(f"when {had(stage)} then '{stage}'" for _, stage in upward)
    progressed = [
        f"coalesce({had(stage)} and {had(before)}, false) as {PROGRESS_FLAGS[stage]}"
        for before, stage in zip(STAGES, STAGES[1:], strict=False)
    ]
    channel = channel_sql("attributed_medium", "attributed_source")
    return [
        "session_id",
        "user_pseudo_id",
        "transaction_id",
        "session_date",
        "session_start_at",
        "session_end_at",
        "session_duration_seconds",
        "attributed_source",
        "attributed_medium",
        "attributed_campaign",
        f"{channel} as channel_group",
        "device_category",
        "country",
        f"case {numbers} else 0 end as max_funnel_stage",
        f"case {names} else '{UNKNOWN_STAGE}' end as deepest_stage_name",
        *[had(stage) for stage in STAGES],
        "session_revenue",
        "is_engaged_session",
        "total_events",
        f"{had('purchase')} as is_converted",
        *progressed,
        *(["current_timestamp() as loaded_at"] if with_load_time else []),
    ]
