"""Stored results: views, and tables partitioned by day."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tributary.operators.columns import quoted
from tributary.plans.events import flatten_events
from tributary.plans.funnel import funnel_steps
from tributary.plans.sessions import build_sessions
from tributary.plans.summary import funnel_summary
from tributary.sources.events import EVENT_SCHEMA
from tributary.sources.versions import (
    Version,
    current_version,
    publish,
    publish_table,
    read_version,
    version_age,
    write_table_version,
    write_version,
)

DAY = "session_date"
#: Reports show stored data for this long before they ask for newer.
REPORT_SECONDS = 3600.0
CLUSTERING = ("attributed_medium", "attributed_source", "device_category")


def publish_view(df: DataFrame, name: str) -> DataFrame:
    """Make a plan available to SQL under a name; nothing is computed."""
    df.createOrReplaceTempView(name)
    return df


def _write(df: DataFrame, sort_by: tuple[str, ...]) -> DataFrameWriter:
    """Writer of a table partitioned by day.

    With ``sort_by`` rows are put in order over all files: the range exchange cuts at sampled
    quantiles of day and these columns, so each file of a day holds a range of its own, and
    adaptive execution joins small neighbours. Rows equal in all of them are told apart by a
    hash, which lets a combination that holds most of a day go to several tasks and files.

    Without ``sort_by`` rows are gathered by day so that a day becomes few files. The
    rebalance hint lets adaptive execution cut a day that is far above the advisory partition
    size into several tasks and files, where a plain repartition would make a single task of
    it, and join small days into one task.
    """
    if sort_by:
        apart = F.pmod(F.xxhash64(*[F.col(quoted(name)) for name in df.columns]), F.lit(64))
        gathered = df.repartitionByRange(DAY, *sort_by, apart)
    else:
        gathered = df.hint("rebalance", DAY)
    ordered = gathered.sortWithinPartitions(DAY, *sort_by)
    return ordered.write.format("parquet").partitionBy(DAY)


@dataclass(frozen=True)
class _Written:
    """A version of a mart that readers do not see yet."""

    spark: SparkSession
    target: str
    version: Version | str

    @property
    def source(self) -> str:
        return self.version if isinstance(self.version, str) else self.version.path

    def publish(self) -> None:
        if isinstance(self.version, str):
            publish_table(self.spark, self.target, self.version)
        else:
            publish(self.spark, self.target, self.version)


def _written(
    df: DataFrame, target: str, sort_by: tuple[str, ...], as_table: bool
) -> _Written:
    spark, writer = df.sparkSession, _write(df, sort_by)
    if as_table:
        return _Written(spark, target, write_table_version(spark, target, writer.saveAsTable))
    return _Written(spark, target, write_version(spark, target, writer.save))


def write_funnel_steps(facts: DataFrame, target: str, as_table: bool = False) -> None:
    """Write the funnel facts, full refresh, to a path or a catalog table.

    Readers see the old facts until the new ones are whole (see ``sources.versions``). Files
    of a day hold ranges of medium, source and device, and rows are sorted by them, so a
    filter on these columns reads few files and skips row groups of these.
    """
    _written(facts, target, CLUSTERING, as_table).publish()


def write_funnel_summary(summary: DataFrame, target: str, as_table: bool = False) -> None:
    """Write the summary, full refresh, to a path or a catalog table."""
    _written(summary, target, (), as_table).publish()


def refresh_marts(
    records: DataFrame,
    steps_target: str,
    summary_target: str,
    as_table: bool = False,
    money_type: str | None = None,
) -> None:
    """Rebuild both marts from event records; the summary is made from the stored facts.

    Both are written before either is shown to readers, so a refresh that fails leaves both
    as they were. Records of an empty range give empty marts. Old versions stay readable until
    ``release_versions`` or ``release_tables`` removes them.
    """
    spark = records.sparkSession
    facts = funnel_steps(
        build_sessions(flatten_events(records), money_type), with_load_time=True
    )
    steps = _written(facts, steps_target, CLUSTERING, as_table)
    stored_facts = _read(spark, steps.source, as_table, facts.schema)
    summary = _written(funnel_summary(stored_facts, money_type), summary_target, (), as_table)
    steps.publish()
    summary.publish()


def summary_schema(spark: SparkSession) -> StructType:
    """Columns of the stored summary, for reading one that may be empty."""
    records = spark.createDataFrame([], EVENT_SCHEMA)
    return funnel_summary(funnel_steps(build_sessions(flatten_events(records)))).schema


def read_mart(
    spark: SparkSession, source: str, as_table: bool = False, schema: StructType | None = None
) -> DataFrame:
    """A stored table as last published; a filter on ``session_date`` reads only those days.

    A path without rows has no files to tell its columns: pass their ``schema`` then.
    """
    if as_table:
        return spark.table(source)
    if current_version(spark, source):
        return read_version(spark, source, schema)
    return _read(spark, source, False, schema)  # a plain folder


def fresh_mart(
    spark: SparkSession,
    source: str,
    refresh: Callable[[], None],
    max_age: float = REPORT_SECONDS,
    schema: StructType | None = None,
) -> DataFrame:
    """A stored mart published at most ``max_age`` seconds ago, as ``read_mart`` reads it.

    An older one, or one never published, is first rebuilt by ``refresh``, which must publish
    ``source`` and should make its plans anew, so that input that has come since is seen. All
    sessions that share the folder share its age. If ``refresh`` fails the error is raised,
    and the old rows stay readable with ``read_mart``; two sessions that find a mart too old
    at once both rebuild it, and readers see the one that ended last.
    """
    age = version_age(spark, source)
    if age is None or age >= max_age:
        refresh()
    return read_mart(spark, source, schema=schema)


def _read(
    spark: SparkSession, source: str, as_table: bool, schema: StructType | None
) -> DataFrame:
    if as_table:
        return spark.table(source)
    return (spark.read.schema(schema) if schema else spark.read).parquet(source)
