"""Column functions built from Spark's own expressions; none uses Python workers."""

from tributary.functions.arithmetic import (
    exact_sum,
    safe_add,
    safe_divide,
    safe_subtract,
    total,
    total_sql,
    width_bucket,
)
from tributary.functions.dates import add_parts, intervals_between
from tributary.functions.geo import degrees_to_radians, haversine_distance
from tributary.functions.keys import (
    surrogate_key,
    surrogate_key_sql,
    timestamp_text,
    timestamp_text_sql,
)
from tributary.functions.text import slug, slugify
from tributary.functions.urls import url_host, url_parameter, url_path

__all__ = [
    "add_parts",
    "degrees_to_radians",
    "exact_sum",
    "haversine_distance",
    "intervals_between",
    "safe_add",
    "safe_divide",
    "safe_subtract",
    "slug",
    "slugify",
    "surrogate_key",
    "surrogate_key_sql",
    "timestamp_text",
    "timestamp_text_sql",
    "total",
    "total_sql",
    "url_host",
    "url_parameter",
    "url_path",
    "width_bucket",
]
