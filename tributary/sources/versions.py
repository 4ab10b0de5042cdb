"""Stored tables that are replaced as a whole, while others read them.

A table is a folder. Each refresh writes a version of its own below ``_versions`` and then
publishes it by one empty file below ``_published``, whose name holds the version and its
number. Until that file is there readers see the version before, also after a refresh that
was killed halfway; plans made earlier go on reading the files of theirs. Old versions stay
until they are released.

Tables of the catalog work the same way: a version is a table of its own, and what readers
know by name is a view on it, replaced by one change in the catalog.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from typing import NamedTuple
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tributary.operators.columns import quoted

_VERSIONS, _PUBLISHED = "_versions", "_published"


class Version(NamedTuple):
    number: int
    name: str
    path: str


def _folder(spark: SparkSession, path: str):
    """The file system of a path, and the path as it knows it."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders right below a path; none if there is no such path."""
    files, place = _folder(spark, path)
    if not files.exists(place):
        return []
    return [status.getPath().getName() for status in files.listStatus(place)]


def _pointer(target: str, version: Version) -> str:
    return f"{target.rstrip('/')}/{_PUBLISHED}/{version.number:012d}.{version.name}"


def published_versions(spark: SparkSession, target: str) -> list[Version]:
    """The published versions of a table, the oldest first.

    Two refreshes that end at the same time get the same number; their names settle which
    of them is the later one, for all readers alike.
    """
    root = target.rstrip("/")
    found = []
    for entry in folder_names(spark, f"{root}/{_PUBLISHED}"):
        number, _, name = entry.partition(".")
        if number.isdigit() and name:
            found.append(Version(int(number), name, f"{root}/{_VERSIONS}/{name}"))
    return sorted(found)


def current_version(spark: SparkSession, target: str) -> Version | None:
    """The version that readers see; ``None`` if nothing was ever published."""
    return max(published_versions(spark, target), default=None)


def version_age(spark: SparkSession, target: str) -> float | None:
    """Seconds since the current version was published, by the clock of the file system that
    holds it; ``None`` if nothing was ever published."""
    version = current_version(spark, target)
    if version is None:
        return None
    files, place = _folder(spark, _pointer(target, version))
    return max(0.0, time.time() - files.getFileStatus(place).getModificationTime() / 1000)


def write_version(spark: SparkSession, target: str, write: Callable[[str], None]) -> Version:
    """Writes a version with ``write(path)``, without showing it to readers; see ``publish``."""
    name = uuid4().hex
    path = f"{target.rstrip('/')}/{_VERSIONS}/{name}"
    write(path)
    return Version(0, name, path)


def publish(spark: SparkSession, target: str, version: Version) -> Version:
    """Makes a written version the one that readers see."""
    latest = current_version(spark, target)
    shown = Version(latest.number + 1 if latest else 1, version.name, version.path)
    files, place = _folder(spark, _pointer(target, shown))
    files.create(place, False).close()
    return shown


def read_version(
    spark: SparkSession, target: str, schema: StructType | None = None, number: int | None = None
) -> DataFrame:
    """The current version, or one of an earlier number, as it stands when this is called."""
    for version in reversed(published_versions(spark, target)):
        if number is None or version.number == number:
            return (spark.read.schema(schema) if schema else spark.read).parquet(version.path)
    wanted = "no version" if number is None else f"no version {number}"
    raise FileNotFoundError(f"{wanted} of {target} has been published")


def release_versions(
    spark: SparkSession, target: str, keep: int = 1, unfinished: bool = False
) -> list[Version]:
    """Deletes all but the last ``keep`` published versions; returns those it deleted.

    Plans that still read them fail afterwards. With ``unfinished`` it also deletes what
    refreshes have written that never ended; none may be running then.
    """
    if keep < 1:
        raise ValueError("at least the current version is kept")
    published = published_versions(spark, target)
    gone = published[:-keep]
    root = target.rstrip("/")
    for version in gone:
        files, place = _folder(spark, _pointer(target, version))
        files.delete(place, False)
    left = {version.name for version in published} if unfinished else set()
    lost = [name for name in folder_names(spark, f"{root}/{_VERSIONS}") if unfinished and name not in left]
    for path in [*(version.path for version in gone), *(f"{root}/{_VERSIONS}/{n}" for n in lost)]:
        files, place = _folder(spark, path)
        files.delete(place, True)
    return gone


def _table_name(target: str, name: str) -> str:
    *schema, table = target.split(".")
    return ".".join([*schema, quoted(f"{table}__{name}")])


def write_table_version(spark: SparkSession, target: str, write: Callable[[str], None]) -> str:
    """Writes a table beside ``target`` with ``write(name)`` and returns its name."""
    name = _table_name(target, uuid4().hex)
    write(name)
    return name


def publish_table(spark: SparkSession, target: str, name: str) -> None:
    """Makes ``target``, a view, show the rows of the table ``name``."""
    try:
        spark.sql(f"create or replace view {target} as select * from {name}")
    except AnalysisException as error:
        if spark.catalog.tableExists(target) and not _is_view(spark, target):
            raise ValueError(
                f"{target} is a plain table; rename it, so that a view can take its name"
            ) from error
        raise


def _is_view(spark: SparkSession, target: str) -> bool:
    return spark.catalog.getTable(target).tableType == "VIEW"


def table_versions(spark: SparkSession, target: str) -> list[str]:
    """Names of the tables written for ``target``, published or not, in no order."""
    *schema, table = target.split(".")
    listed = spark.catalog.listTables(".".join(schema) or None, f"{table}__*")
    return [
        ".".join([*schema, quoted(entry.name)])
        for entry in listed
        if not entry.isTemporary and entry.tableType != "VIEW"
    ]


def release_tables(spark: SparkSession, target: str) -> list[str]:
    """Drops all tables written for ``target`` but the one it shows; none may be in writing."""
    text = spark.sql(f"show create table {target}").head()[0]
    gone = [name for name in table_versions(spark, target) if quoted_part(name) not in text]
    for name in gone:
        spark.sql(f"drop table {name}")
    return gone


def quoted_part(name: str) -> str:
    """The last part of a name without quotes; versions hold a number that is theirs alone."""
    return name.rsplit(".", 1)[-1].strip("`")
