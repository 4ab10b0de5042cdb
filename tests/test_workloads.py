"""Every registered query gives the rows of its SQL."""

from __future__ import annotations

import os

import duckdb
import pytest

from workloads import ORACLE, QUERIES, models

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    yield connection
    connection.close()


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    expected = duck.execute(ORACLE[name])
    names = [column[0] for column in expected.description]
    assert sorted(df.columns) == sorted(names)
    got = sorted(repr(tuple(row)) for row in df.select(*[f"`{n}`" for n in names]).collect())
    assert got == sorted(repr(row) for row in expected.fetchall())


def test_every_day_has_its_table(spark):
    before = {row.namespace for row in spark.sql("show databases like 'daily_*'").collect()}
    QUERIES["event_scan_tables"](spark, SF)
    after = {row.namespace for row in spark.sql("show databases like 'daily_*'").collect()}
    (schema,) = after - before
    tables = spark.sql(f"show tables in {schema}").where("not isTemporary")
    names = {row.tableName for row in tables.collect()}
    days = models.records(spark, SF).where("event_date is not null").select("event_date")
    assert names == {f"events_{row.event_date}" for row in days.distinct().collect()}
    assert len(names) > 9
