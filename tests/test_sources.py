from __future__ import annotations

import glob
import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tributary.plans import (
    flatten_events,
    publish_view,
    read_mart,
    refresh_marts,
    summary_schema,
    write_funnel_steps,
    write_funnel_summary,
)
from tributary.sources import scratch
from tributary.sources import (
    Relation,
    clear_scratch,
    current_version,
    read_event_tables,
    read_events,
    read_seed,
    relations_by_pattern,
    relations_by_prefix,
    scratch_path,
    stored,
)
from tests.conftest import values
from tests.test_models import EVENT_SCHEMA, event


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def three_days(spark):
    rows = [event("u", 1, i, "page_view", day=f"2020110{i}") for i in (1, 2, 3)]
    return spark.createDataFrame(rows, EVENT_SCHEMA)


def test_scan_reads_only_the_days_asked_for(spark, three_days, tmp_path):
    path = str(tmp_path / "events")
    three_days.write.partitionBy("event_date").parquet(path)
    week = read_events(spark, path, "20201102", "20201103")
    assert values(week.select("event_date")) == [("20201102",), ("20201103",)]
    scan = plan(week.select("event_name"))
    filters = scan.split("PartitionFilters: [")[1].split("]")[0]
    assert "event_date" in filters
    assert read_events(spark, path, "20200101", "20301231").count() == 3


def test_scan_reads_only_needed_members(spark, three_days, tmp_path):
    path = str(tmp_path / "events")
    three_days.write.partitionBy("event_date").parquet(path)
    scan = plan(flatten_events(read_events(spark, path, "20201101", "20201130")).select("ga_session_id"))
    schema = scan.split("ReadSchema: ")[1]
    assert "int_value" in schema and "string_value" not in schema
    assert "medium" in schema and "campaign" not in schema and "ecommerce" not in schema
    pushed = scan.split("PushedFilters: ")[1].split("ReadSchema")[0]
    assert "user_pseudo_id" in pushed and "traffic_source.medium" in pushed


def test_daily_tables(spark, three_days):
    spark.sql("create database if not exists days_db")
    for i in (1, 2, 3):
        rows = three_days.where(F.col("event_date") == f"2020110{i}")
        rows.write.mode("overwrite").saveAsTable(f"days_db.events_2020110{i}")
    found = read_event_tables(spark, "days_db", start="20201102", end="20201131")
    assert values(found.select("event_date")) == [("20201102",), ("20201103",)]
    with pytest.raises(ValueError):
        read_event_tables(spark, "days_db", start="20210101", end="20210102")


def test_daily_tables_of_different_shape(spark, three_days):
    """Records gain and lose members; only needed members are read all the same."""
    spark.sql("create database if not exists drift_db")
    shapes = {
        1: three_days,
        2: three_days.withColumn("traffic_source", F.col("traffic_source").withField("term", F.lit("x"))),
        3: three_days.drop("geo").withColumn("device", F.col("device").dropFields("category")),
    }
    for i, shape in shapes.items():
        shape.write.mode("overwrite").saveAsTable(f"drift_db.events_2020110{i}")
    found = read_event_tables(spark, "drift_db", "20201101", "20201103")
    assert found.schema.simpleString() == three_days.schema.simpleString()
    flat = flatten_events(found)
    assert flat.count() == 9
    assert flat.where("device_category is null").count() >= 3
    scans = plan(flat.select("ga_session_id")).split("ReadSchema: ")[1:]
    assert len(scans) == 3
    for scan in scans:
        schema = scan.split("\n")[0]
        assert "campaign" not in schema and "ecommerce" not in schema and "term" not in schema


def test_refresh_of_an_empty_range(spark, three_days, tmp_path):
    none = three_days.where("event_date > '20990101'")
    refresh_marts(none, str(tmp_path / "steps"), str(tmp_path / "summary"))
    summary = read_mart(spark, str(tmp_path / "summary"), schema=summary_schema(spark))
    assert summary.count() == 0
    assert len(summary.columns) == 26


def test_catalog_lookup(spark):
    spark.sql("create database if not exists Shop_a")
    spark.sql("create database if not exists shop_b")
    for name in ("shop_a.data_events_1", "shop_a.data_events_2", "shop_b.data_events_3", "shop_b.x"):
        spark.range(1).write.mode("overwrite").saveAsTable(name)
    spark.sql("create or replace view shop_a.data_events_v as select 1 as id")
    assert relations_by_prefix(spark, "shop_a", "DATA_events_") == [
        Relation("shop_a", "data_events_1", "table"),
        Relation("shop_a", "data_events_2", "table"),
        Relation("shop_a", "data_events_v", "view"),
    ]
    found = relations_by_pattern(spark, "SHOP%", "data_events__", exclude="%_2")
    assert [relation.path for relation in found] == [
        "shop_a.data_events_1", "shop_a.data_events_v", "shop_b.data_events_3",
    ]
    assert found[0].read(spark).count() == 1
    assert relations_by_pattern(spark, "nowhere", "%") == []
    elsewhere = relations_by_prefix(spark, "shop_b", "data_", database="spark_catalog")
    assert [relation.path for relation in elsewhere] == ["spark_catalog.shop_b.data_events_3"]
    assert elsewhere[0].read(spark).count() == 1
    spark.range(2).createOrReplaceTempView("temp_rows_1")
    assert relations_by_prefix(spark, "", "temp_rows_") == [Relation("", "temp_rows_1", "view")]


def test_seed_types_and_names(spark, tmp_path):
    path = tmp_path / "seed.csv"
    path.write_text("﻿Date_Value,Float_Value,int_value,code\n2017-01-01 00:00:00,3.3,19,007\n,,,\n")
    df = read_seed(spark, str(path), {"date_value": "timestamp", "code": "string"})
    assert df.columns == ["date_value", "float_value", "int_value", "code"]
    assert [kind for _, kind in df.dtypes] == ["timestamp", "double", "int", "string"]
    assert values(df) == [(None,) * 4, (datetime(2017, 1, 1), 3.3, 19, "007")]
    assert read_seed(spark, str(path), quote_columns=True).columns[0] == "Date_Value"


def test_seed_cells_with_quotes_and_line_breaks(spark, tmp_path):
    path = tmp_path / "seed.csv"
    path.write_text('id,say\n1,"say ""hi"", you"\n2,"two\nlines"\n3,plain\n')
    assert values(read_seed(spark, str(path))) == [
        (1, 'say "hi", you'), (2, "two\nlines"), (3, "plain"),
    ]


def test_scratch_folder(spark, tmp_path):
    df = stored(spark.range(3), "rows")
    path = df.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    assert path.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert os.path.isdir(path)
    assert df.count() == 3
    kept = dict(scratch._made)
    scratch._made[spark.sparkContext.applicationId] = [path]
    clear_scratch(spark)
    assert not os.path.exists(path)
    scratch._made.update(kept)


def test_publish_view(spark):
    publish_view(spark.range(3), "three")
    assert spark.sql("select sum(id) from three").head()[0] == 3


def _facts(spark, rows=200):
    """Two thirds of the rows on one day."""
    return spark.range(rows).selectExpr(
        "cast(id as string) as session_id",
        "date_add(date'2024-01-01', cast(if(id % 3 = 0, id % 5 + 1, 0) as int)) as session_date",
        "concat('m', id % 7) as attributed_medium",
        "concat('s', id % 4) as attributed_source",
        "if(id % 2 = 0, 'desktop', 'mobile') as device_category",
        f"concat({', '.join(['uuid()'] * 8)}) as padding",
    )


def test_marts_are_partitioned_and_clustered(spark, tmp_path):
    path = str(tmp_path / "steps")
    for _ in range(2):
        write_funnel_steps(_facts(spark), path)
    mart = read_mart(spark, path)
    assert mart.count() == 200
    one_day = mart.where("session_date = date'2024-01-02'")
    assert "session_date" in plan(one_day).split("PartitionFilters: [")[1].split("]")[0]
    path = current_version(spark, path).path
    file = glob.glob(f"{path}/session_date=2024-01-02/*.parquet")[0]
    rows = [tuple(r) for r in spark.read.parquet(file).select(
        "attributed_medium", "attributed_source", "device_category").collect()]
    assert rows == sorted(rows)


def test_a_hot_day_is_written_by_several_tasks(spark, tmp_path):
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "200k",
        "spark.sql.files.maxPartitionBytes": "1m",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        path = str(tmp_path / "steps")
        write_funnel_steps(_facts(spark, 8000).repartition(16), path)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert read_mart(spark, path).count() == 8000
    path = current_version(spark, path).path
    assert len(glob.glob(f"{path}/session_date=2024-01-01/*.parquet")) > 2
    assert len(glob.glob(f"{path}/session_date=2024-01-02/*.parquet")) <= 2


def test_marts_as_tables(spark):
    write_funnel_summary(_facts(spark), "summary_table", as_table=True)
    write_funnel_summary(_facts(spark, 30), "summary_table", as_table=True)
    mart = read_mart(spark, "summary_table", as_table=True)
    assert mart.count() == 30
    assert mart.agg(F.min("session_date")).head()[0] == date(2024, 1, 1)


def test_scratch_space_follows_the_setting(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second and first.startswith(root)
    assert values(stored(spark.range(3).toDF("n"), "numbers")) == [(0,), (1,), (2,)]
