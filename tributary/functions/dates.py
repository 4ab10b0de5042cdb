"""Calendar arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tributary.functions._args import ColumnOrExpr, as_column, as_value

_SECONDS = {"second": 1, "minute": 60, "hour": 3600}
_MONTHS = {"month": 1, "quarter": 3, "year": 12}
_DAYS = {"day": 1, "week": 7}
DATE_PARTS = (*_SECONDS, *_DAYS, *_MONTHS)

# A Sunday, so that weeks counted from it begin on Sundays.
_A_SUNDAY = "1970-01-04"


def check_part(part: str) -> str:
    part = part.lower()
    if part not in DATE_PARTS:
        raise ValueError(f"unknown date part {part!r}; use one of {', '.join(DATE_PARTS)}")
    return part


def add_parts(part: str, amount, start: ColumnOrExpr) -> Column:
    """``start`` moved by ``amount`` date parts, as a timestamp."""
    return F.timestamp_add(
        check_part(part).upper(), as_value(amount), as_column(start).cast("timestamp")
    )


def intervals_between(start: ColumnOrExpr, end: ColumnOrExpr, part: str) -> Column:
    """How many boundaries of ``part`` lie between two instants.

    31 January to 1 February is one month, although only a day has passed; weeks
    begin on Sunday.
    """
    part = check_part(part)

    def position(moment: Column) -> Column:
        if part in _SECONDS:
            seconds = F.unix_seconds(moment.cast("timestamp"))
            return F.floor(seconds / F.lit(_SECONDS[part]))
        if part in _DAYS:
            days = F.datediff(moment.cast("date"), F.lit(_A_SUNDAY).cast("date"))
            return F.floor(days / F.lit(_DAYS[part]))
        months = F.year(moment) * F.lit(12) + F.month(moment) - F.lit(1)
        return F.floor(months / F.lit(_MONTHS[part]))

    return (position(as_column(end)) - position(as_column(start))).cast("bigint")
