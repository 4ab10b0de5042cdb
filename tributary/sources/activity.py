"""Plain activity rows turned into nested web event records.

Input rows are ``(event_id, ts, user_id, event_type, value, props)``. Every value
of the record follows from the row alone, so the mapping is a projection: no
shuffle, no state, no randomness.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tributary.functions._args import sql_list

MEDIA = (
    "cpc", "cpm", "email", "organic", "referral", "(none)", "social", "(not set)", None, "widget",
)
SOURCES = ("google", "facebook", "(direct)", "newsletter", "partner", "bing")
CAMPAIGNS = ("spring_sale", "summer_sale", None, "brand")
DEVICES = ("desktop", "mobile", "tablet")
SYSTEMS = ("Windows", "Android", "iOS", "Macintosh")
COUNTRIES = 25
SHIPPING = 4.99
TAX_RATE = 0.08
NO_SESSION_K = 99


def _pick(number: str, choices: tuple[str | None, ...]) -> str:
    return f"element_at(array({sql_list(choices)}), cast({number} % {len(choices)} as int) + 1)"


def _param(key: str, text: str = "null", number: str = "null") -> str:
    value = (
        f"named_struct('string_value', cast({text} as string),"
        f" 'int_value', cast({number} as bigint))"
    )
    return f"named_struct('key', '{key}', 'value', {value})"


def to_event_records(activity: DataFrame) -> DataFrame:
    """Records in the shape of ``EVENT_SCHEMA``; ``k`` below is the number held in ``props``."""
    rows = activity.selectExpr(
        "event_id",
        "user_id",
        "event_type",
        "value",
        "cast(regexp_extract(props, '[0-9]+', 0) as int) as k",
        "cast(ts as timestamp) as at",
    )
    name = """
        case event_type
            when 'signup' then 'session_start'
            when 'view' then if(k % 2 = 0, 'page_view', 'view_item')
            when 'click' then if(k % 2 = 0, 'add_to_cart', 'begin_checkout')
            when 'error' then if(k % 3 = 0, 'scroll', 'add_payment_info')
            else event_type
        end
    """
    params = ", ".join(
        [
            _param("session_engaged", "if(k % 2 = 0, '1', '0')"),
            _param("page_title", "concat_ws(' ', event_type, k)"),
            _param("page_location", "concat('https://shop.example/', event_type, '?k=', k)"),
        ]
    )
    session = _param("ga_session_id", number="unix_date(cast(at as date))")
    sold = "event_type = 'purchase'"
    return rows.selectExpr(
        "date_format(at, 'yyyyMMdd') as event_date",
        "unix_micros(at) as event_timestamp",
        f"{name} as event_name",
        "cast(user_id as string) as user_pseudo_id",
        f"if(k <> {NO_SESSION_K}, array({session}, {params}), array({params})) as event_params",
        f"""named_struct('medium', {_pick("k", MEDIA)}, 'source', {_pick("user_id", SOURCES)},
            'name', {_pick("k", CAMPAIGNS)}) as traffic_source""",
        f"""named_struct('category', {_pick("user_id", DEVICES)},
            'operating_system', {_pick("user_id", SYSTEMS)}) as device""",
        f"named_struct('country', cast(user_id % {COUNTRIES} as string)) as geo",
        f"""named_struct('transaction_id', if({sold}, cast(event_id as string), null),
            'purchase_revenue', if({sold}, value, null),
            'tax_value', if({sold}, value * {TAX_RATE}D, null),
            'shipping_value', if({sold}, {SHIPPING}D, null)) as ecommerce""",
        f"""if({sold} or (event_type = 'click' and k % 2 = 0),
            array_repeat(named_struct('item_id', cast(k as string)), k % 4), null) as items""",
    )
