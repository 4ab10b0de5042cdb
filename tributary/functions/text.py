"""Names fit for columns and addresses."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tributary.functions._args import ColumnOrExpr, as_column

# The pattern and its replacement, applied in this order to lower-cased text.
SLUG_STEPS = (
    ("[ -]+", "_"),
    ("[^a-z0-9_]+", ""),
    ("^([0-9])", "_$1"),
)


def slug(text: ColumnOrExpr) -> Column:
    """Lower-case text of letters, digits and underscores; NULL becomes empty text."""
    result = F.lower(F.coalesce(as_column(text), F.lit("")))
    for pattern, replacement in SLUG_STEPS:
        result = F.regexp_replace(result, pattern, replacement)
    return result


def slugify(text: str | None) -> str:
    """The same for one Python string, to name columns with."""
    result = (text or "").lower()
    for pattern, replacement in SLUG_STEPS:
        result = re.sub(pattern, replacement.replace("$1", r"\1"), result)
    return result
