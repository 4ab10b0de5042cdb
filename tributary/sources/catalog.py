"""Tables found in the catalog by name."""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from tributary.operators.columns import quoted

_TABLE_TYPES = {"managed": "table", "base table": "table", "external table": "external"}


class Relation(NamedTuple):
    schema: str
    name: str
    type: str
    database: str | None = None

    @property
    def path(self) -> str:
        return ".".join(part for part in (self.database, self.schema, self.name) if part)

    def read(self, spark: SparkSession) -> DataFrame:
        parts = [part for part in (self.database, self.schema, self.name) if part]
        return spark.table(".".join(quoted(part) for part in parts))


def _ilike(text: str, pattern: str) -> bool:
    wildcards = {"%": ".*", "_": "."}
    regex = "".join(wildcards.get(c, re.escape(c)) for c in pattern)
    return re.fullmatch(regex, text, re.IGNORECASE | re.DOTALL) is not None


def relations_by_pattern(
    spark: SparkSession,
    schema_pattern: str,
    table_pattern: str,
    exclude: str = "",
    database: str | None = None,
) -> list[Relation]:
    """Tables and views whose schema and name match LIKE patterns, letter case ignored.

    Names matching ``exclude`` are left out. ``database`` names a catalog to search
    instead of the current one. Temporary views belong to no schema and are found
    with the empty schema pattern.
    """
    catalog = spark.catalog
    # The catalog knows "*" only, which also stands for the single letter of LIKE.
    listed_as = re.sub(r"[%_]+", "*", table_pattern)
    before = catalog.currentCatalog()
    if database:
        catalog.setCurrentCatalog(database)
    try:
        schemas = [db.name for db in catalog.listDatabases() if _ilike(db.name, schema_pattern)]
        listed = [
            ("" if table.isTemporary else schema, table)
            for schema in schemas or [catalog.currentDatabase()]
            for table in catalog.listTables(schema, listed_as)
        ]
    finally:
        if database:
            catalog.setCurrentCatalog(before)
    found = set()
    for owner, table in listed:
        wanted = _ilike(owner, schema_pattern) and _ilike(table.name, table_pattern)
        if wanted and not _ilike(table.name, exclude):
            kind = "view" if table.isTemporary else (table.tableType or "").lower()
            found.add(Relation(owner, table.name, _TABLE_TYPES.get(kind, kind), database))
    return sorted(found, key=lambda relation: relation.path)


def relations_by_prefix(
    spark: SparkSession,
    schema: str,
    prefix: str,
    exclude: str = "",
    database: str | None = None,
) -> list[Relation]:
    """The same for names that begin with ``prefix``."""
    return relations_by_pattern(spark, schema, prefix + "%", exclude, database)


class Described(NamedTuple):
    """A table as the catalog lists it; ``shape`` tells tables with equal columns apart from
    others, and is empty where the folder alone is not the table."""

    schema: str
    name: str
    location: str
    shape: str

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.table(f"{quoted(self.schema)}.{quoted(self.name)}")


def described_tables(spark: SparkSession, schema: str, prefix: str) -> list[Described]:
    """Tables and views of a schema whose names begin with ``prefix``, from one listing."""
    found = []
    # The catalog reads "|" and "*" as signs, so the prefix is checked again.
    pattern = re.sub(r"[^A-Za-z0-9_]+", "*", prefix) + "*"
    listed = spark.sql(f"show table extended in {quoted(schema)} like '{pattern}'")
    for row in listed.where("not isTemporary").collect():
        if not row.tableName.lower().startswith(prefix.lower()):
            continue
        told, _, columns = row.information.partition("\nSchema: root\n")
        facts = dict(line.split(": ", 1) for line in told.split("\n") if ": " in line)
        plain = facts.get("Provider", "").lower() == "parquet" and "Partition Columns" not in facts
        plain = plain and facts.get("Type") != "VIEW" and "Location" in facts
        found.append(
            Described(schema, row.tableName, facts.get("Location", ""), columns if plain else "")
        )
    return sorted(found)
