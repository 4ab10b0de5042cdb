"""Number series and date spines, made on the executors."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from tributary.functions.dates import add_parts, check_part, intervals_between

_CALENDAR_PARTS = ("day", "week", "month", "quarter", "year")


def generate_series(spark: SparkSession, upper_bound: int) -> DataFrame:
    """The integers 1 to ``upper_bound`` as ``generated_number``."""
    if upper_bound <= 0:
        raise ValueError(f"upper bound must be positive, got {upper_bound}")
    return spark.range(1, upper_bound + 1).withColumnRenamed("id", "generated_number")


def _moment(value: str | date | datetime | Column) -> Column:
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        return F.lit(value).cast("date" if len(value) == 10 else "timestamp")
    return F.lit(value)


def date_spine(
    spark: SparkSession,
    datepart: str,
    start_date: str | date | datetime | Column,
    end_date: str | date | datetime | Column,
) -> DataFrame:
    """One row for each period from the start (included) to the end (excluded).

    The column is ``date_<part>``: a date if the start is one and the periods are
    days or longer, else a timestamp.
    """
    part = check_part(datepart)
    start, end = _moment(start_date), _moment(end_date)
    bounds = spark.range(1).select(
        start.alias("start"), end.alias("end"), intervals_between(start, end, part).alias("n")
    )
    periods = bounds.head()["n"]
    if periods is None or periods <= 0:
        raise ValueError(f"the end must lie at least one {part} after the start")
    whole_days = part in _CALENDAR_PARTS and isinstance(bounds.schema["start"].dataType, DateType)
    name = f"date_{part}"
    moment = add_parts(part, F.col("id"), start).cast("date" if whole_days else "timestamp")
    spine = spark.range(periods).select(moment.alias(name))
    return spine.where(F.col(name) <= end)
