"""Parts of an address, taken from its text.

These are text rules, not a parser: fragments stay in the path, an address may lack
a scheme, and a parameter name also matches at the end of a longer one.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tributary.functions._args import ColumnOrExpr, as_column

# Schemes that are cut off.
WEB_SCHEMES = ("http://", "https://")
HOST_SCHEMES = ("android-app://", *WEB_SCHEMES)


def _without(text: Column, schemes: tuple[str, ...]) -> Column:
    for scheme in schemes:
        text = F.replace(text, F.lit(scheme), F.lit(""))
    return text


def _part(text: Column, separator: str, number: int) -> Column:
    return F.split_part(text, F.lit(separator), F.lit(number))


def url_host(url: ColumnOrExpr) -> Column:
    """Text between the scheme and the first slash or question mark."""
    return _part(_part(_without(as_column(url), HOST_SCHEMES), "/", 1), "?", 1)


def url_path(url: ColumnOrExpr) -> Column:
    """Text after the first slash, up to the first question mark.

    Without a slash the path is empty if there is a query, else the whole text.
    """
    text = _without(as_column(url), WEB_SCHEMES)
    slash = F.locate("/", text)
    after_slash = F.substring(text, slash + F.lit(1), F.length(text))
    query_only = F.when(F.locate("?", text) > 0, F.lit("")).otherwise(text)
    return _part(F.when(slash > 0, after_slash).otherwise(query_only), "?", 1)


def url_parameter(url: ColumnOrExpr, name: str) -> Column:
    """Value of a query parameter, NULL if it is missing or empty."""
    value = _part(_part(as_column(url), f"{name}=", 2), "&", 1)
    return F.nullif(value, F.lit(""))
