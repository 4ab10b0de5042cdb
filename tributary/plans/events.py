"""Nested event records to flat, typed events with keys."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tributary.functions import surrogate_key_sql, timestamp_text_sql

# Traffic with this medium comes from bots and tests.
TEST_MEDIUM = "(not set)"


def event_param(key: str, member: str) -> str:
    """SQL text for the value of a parameter in ``event_params``, NULL if it is missing.

    Looking up the position among the keys stays inside generated code and reads
    only the needed members of the nested records; ``get`` gives NULL for the
    position before the first, which stands for a missing key.
    """
    position = f"array_position(event_params.key, '{key}')"
    return f"get(event_params.value.{member}, cast({position} - 1 as int))"


#: Members of the records that become columns, and those that are records of real traffic.
COLUMNS = (
    "to_date(event_date, 'yyyyMMdd') as event_date",
    "timestamp_micros(event_timestamp) as event_timestamp",
    "event_name",
    "user_pseudo_id",
    f"{event_param('ga_session_id', 'int_value')} as ga_session_id",
    f"{event_param('session_engaged', 'string_value')} as session_engaged",
    f"{event_param('page_title', 'string_value')} as page_title",
    f"{event_param('page_location', 'string_value')} as page_location",
    "traffic_source.medium as traffic_medium",
    "traffic_source.source as traffic_source",
    "traffic_source.name as campaign_name",
    "device.category as device_category",
    "device.operating_system as operating_system",
    "geo.country as country",
    "ecommerce.transaction_id",
    "ecommerce.purchase_revenue",
    "ecommerce.tax_value",
    "ecommerce.shipping_value",
    "array_size(items) as item_count",
)
REAL = f"traffic_source.medium <> '{TEST_MEDIUM}' and user_pseudo_id is not null"

SESSION = ("user_pseudo_id", "ga_session_id")
KEYS = (
    f"{surrogate_key_sql([*SESSION, timestamp_text_sql('event_timestamp')])} as event_id",
    f"{surrogate_key_sql(SESSION)} as session_id",
)


def flatten_events(records: DataFrame) -> DataFrame:
    """One row for each real event.

    Test traffic, events with an unknown medium and events without a user are dropped.
    """
    return records.where(REAL).selectExpr(*COLUMNS).selectExpr(*KEYS, "*")


def events_sql(source: str) -> str:
    """The same as a SELECT over a table or path of records, given as SQL text."""
    flat = f"select {', '.join(COLUMNS)} from {source} where {REAL}"
    return f"select {', '.join(KEYS)}, * from ({flat})"
