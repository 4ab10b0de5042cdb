"""Marts under refresh, views of the catalog, many daily tables."""

from __future__ import annotations

import glob
import os
import time
from datetime import date

import pyarrow.parquet as pq
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tributary.plans import (
    build_sessions,
    create_model_views,
    flatten_events,
    fresh_mart,
    funnel_steps,
    funnel_summary,
    read_mart,
    refresh_marts,
    write_funnel_steps,
    write_funnel_summary,
)
from tributary.sources import (
    EVENT_SCHEMA,
    current_version,
    described_tables,
    publish,
    published_versions,
    read_event_tables,
    read_version,
    release_tables,
    release_versions,
    scratch,
    scratch_path,
    table_versions,
    version_age,
    write_event_tables,
    to_event_records,
    write_version,
)
from tests.conftest import values


def facts(spark, rows, mediums=7):
    return spark.range(rows).selectExpr(
        "cast(id as string) as session_id",
        "date_add(date'2024-01-01', cast(id % 2 as int)) as session_date",
        f"concat('m', id % {mediums}) as attributed_medium",
        "concat('s', id % 4) as attributed_source",
        "if(id % 3 = 0, 'desktop', 'mobile') as device_category",
        "uuid() as padding",
    )


def failing(df):
    """The same rows, of which the last ones cannot be computed."""
    broken = F.when(F.col("session_id") == "90", F.raise_error(F.lit("killed midway")).cast("string"))
    return df.withColumn("padding", F.coalesce(broken, F.col("padding")))


def test_a_failed_refresh_leaves_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "mart")
    write_funnel_steps(facts(spark, 60), path)
    plan = read_mart(spark, path)
    with pytest.raises(PySparkException, match="killed midway"):
        write_funnel_steps(failing(facts(spark, 100)), path)
    assert read_mart(spark, path).count() == plan.count() == 60
    write_funnel_steps(facts(spark, 100), path)
    assert read_mart(spark, path).count() == 100
    assert plan.count() == 60  # read before, still on the files of its version
    assert read_version(spark, path, number=1).count() == 60
    assert [v.number for v in published_versions(spark, path)] == [1, 2]


def test_a_version_is_seen_once_it_is_published(spark, tmp_path):
    path = str(tmp_path / "t")
    assert current_version(spark, path) is None
    with pytest.raises(FileNotFoundError):
        read_version(spark, path)
    written = write_version(spark, path, spark.range(3).write.parquet)
    assert current_version(spark, path) is None
    published = publish(spark, path, written)
    assert published.number == 1 and read_version(spark, path).count() == 3
    with pytest.raises(FileNotFoundError):
        read_version(spark, path, number=2)


def test_release_keeps_what_is_read(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in (1, 2, 3):
        publish(spark, path, write_version(spark, path, spark.range(n).write.parquet))
    write_version(spark, path, spark.range(9).write.parquet)  # never published
    assert len(glob.glob(f"{path}/_versions/*")) == 4
    assert [v.number for v in release_versions(spark, path, keep=2)] == [1]
    assert len(glob.glob(f"{path}/_versions/*")) == 3
    assert release_versions(spark, path, keep=2, unfinished=True) == []
    assert len(glob.glob(f"{path}/_versions/*")) == 2
    assert read_version(spark, path).count() == 3
    assert read_version(spark, path, number=2).count() == 2
    publish(spark, path, write_version(spark, path, spark.range(4).write.parquet))
    assert current_version(spark, path).number == 4
    with pytest.raises(ValueError, match="kept"):
        release_versions(spark, path, keep=0)


def test_refreshes_that_end_together(spark, tmp_path):
    """Both get a number; every reader sees the same one."""
    path = str(tmp_path / "t")
    one, two = (write_version(spark, path, spark.range(n).write.parquet) for n in (1, 2))
    publish(spark, path, one)

    (tmp_path / "t" / "_published" / f"{1:012d}.{two.name}").touch()
    winner = max((one, two), key=lambda v: v.name)
    assert current_version(spark, path).name == winner.name
    assert read_version(spark, path).count() == (1 if winner is one else 2)


def test_tables_are_replaced_by_one_change_of_the_catalog(spark):
    spark.sql("create database if not exists swaps")
    write_funnel_summary(facts(spark, 60), "swaps.mart", as_table=True)
    plan = spark.table("swaps.mart")
    with pytest.raises(PySparkException, match="killed midway"):
        write_funnel_summary(failing(facts(spark, 100)), "swaps.mart", as_table=True)
    assert spark.table("swaps.mart").count() == 60
    write_funnel_summary(facts(spark, 100), "swaps.mart", as_table=True)
    assert spark.table("swaps.mart").count() == 100 and plan.count() == 60
    assert len(table_versions(spark, "swaps.mart")) >= 2
    release_tables(spark, "swaps.mart")
    assert len(table_versions(spark, "swaps.mart")) == 1
    assert spark.table("swaps.mart").where("session_date = date'2024-01-01'").count() == 50
    spark.range(1).write.saveAsTable("swaps.plain")
    with pytest.raises(ValueError, match="plain table"):
        write_funnel_summary(facts(spark, 5), "swaps.plain", as_table=True)


def test_plain_folders_are_still_read(spark, tmp_path):
    facts(spark, 10).write.partitionBy("session_date").parquet(str(tmp_path / "old"))
    assert read_mart(spark, str(tmp_path / "old")).count() == 10


@pytest.mark.parametrize("hot", [False, True])
def test_files_of_a_day_hold_ranges_of_their_own(spark, tmp_path, hot):
    """With and without a combination that holds nearly all rows of a day."""
    settings = {
        "spark.sql.shuffle.partitions": "12",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "10k",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        rows = facts(spark, 20_000, 40)
        if hot:
            often = F.col("session_id").cast("int") % 10 > 0
            rows = rows.withColumns({
                name: F.when(often, F.lit("m1")).otherwise(F.col(name))
                for name in ("attributed_medium", "attributed_source", "device_category")
            })
        write_funnel_steps(rows, str(tmp_path / "mart"))
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    path = current_version(spark, str(tmp_path / "mart")).path
    columns = ["attributed_medium", "attributed_source", "device_category"]
    for day in ("2024-01-01", "2024-01-02"):
        files = glob.glob(f"{path}/session_date={day}/*.parquet")
        assert len(files) > 3
        tables = [[*zip(*(pq.read_table(f)[c].to_pylist() for c in columns))] for f in files]
        ends = sorted((rows[0], rows[-1]) for rows in tables)
        assert all(rows == sorted(rows) for rows in tables)
        assert all(a[1] <= b[0] for a, b in zip(ends, ends[1:]))
        if hot:
            assert max(map(len, tables)) < 0.5 * sum(map(len, tables))
        else:
            assert all(sum(a[0] <= m <= b[0] for a, b in ends) <= 3 for m in ("m7", "m22", "m39"))
    assert read_mart(spark, str(tmp_path / "mart")).count() == 20_000


@pytest.fixture
def records(spark):
    rows = [
        (i, i % 7, ["signup", "view", "click", "error", "purchase"][i % 5], float(i), f'{{"k": {i % 100}}}')
        for i in range(300)
    ]
    activity = spark.createDataFrame(rows, "event_id long, user_id long, event_type string, value double, props string")
    ts = F.timestamp_seconds(F.lit(1704067200) + F.col("event_id") * 7000).cast("timestamp_ntz")
    return to_event_records(activity.withColumn("ts", ts))


@pytest.mark.parametrize("money", [None, "decimal(29,9)"])
def test_views_are_read_by_another_session(spark, records, money):
    path = scratch_path(spark, "records")
    records.write.parquet(path)
    spark.sql("create database if not exists views_of_models")
    texts = create_model_views(spark, "views_of_models", f"parquet.`{path}`", money)
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")  # the view keeps its own
    events = flatten_events(spark.read.schema(EVENT_SCHEMA).parquet(path))
    sessions = build_sessions(events, money)
    steps = funnel_steps(sessions)
    wanted = [events, sessions, steps, funnel_summary(steps, money)]
    for name, df in zip(texts, wanted, strict=True):
        view = other.table(name)
        assert view.columns == df.columns
        assert [kind for _, kind in view.dtypes] == [kind for _, kind in df.dtypes]
        keys = [c for c, kind in df.dtypes if kind != "timestamp"]
        assert values(view, *keys) == values(df, *keys)
        assert df.count() > 0
    assert create_model_views(spark, "views_of_models", f"parquet.`{path}`", money) == texts


def test_many_daily_tables_are_a_branch_for_each_shape(spark, records, tmp_path):
    days = [date.fromordinal(date(2024, 1, 1).toordinal() + i).strftime("%Y%m%d") for i in range(60)]
    spark.sql("create database if not exists `many_days`")
    shapes = [
        records, records.drop("geo").withColumn("more", F.lit(1)),
        records.withColumn("device", F.col("device").withField("model", F.lit("x"))),
    ]
    for i, day in enumerate(days):
        path = str(tmp_path / day)
        if i < 3:
            shapes[i].limit(5).withColumn("event_date", F.lit(day)).write.parquet(path)
        else:  # equal files serve for the other days, as every table has its own folder
            (tmp_path / day).symlink_to(tmp_path / days[i % 3])
        columns = shapes[i % 3].schema
        spark.catalog.createTable(f"many_days.events_{day}", path, "parquet", columns)
    found = read_event_tables(spark, "many_days", days[0], days[-2])
    text = found._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan parquet") == 3
    assert found.count() == 59 * 5
    one = read_event_tables(spark, "many_days", days[4], days[4])
    assert one.count() == 5 and one.where("geo is not null").count() == 0
    with pytest.raises(ValueError, match="no tables"):
        read_event_tables(spark, "many_days", "20300101", "20300102")


def test_views_and_tables_without_a_day_beside_plain_ones(spark, records):
    spark.sql("create database if not exists odd_days")
    records.limit(4).write.mode("overwrite").saveAsTable("odd_days.events_20240101")
    records.drop("event_date").limit(3).write.mode("overwrite").saveAsTable("odd_days.events_20240102")
    records.limit(2).write.mode("overwrite").partitionBy("event_name").saveAsTable("odd_days.events_20240103")
    spark.sql("create or replace view odd_days.events_20240104 as select * from odd_days.events_20240101")
    spark.range(1).write.mode("overwrite").saveAsTable("odd_days.eventsX20240101")
    shapes = {t.name: bool(t.shape) for t in described_tables(spark, "odd_days", "EVENTS_")}
    assert shapes == {
        "events_20240101": True, "events_20240102": True, "events_20240103": False, "events_20240104": False,
    }
    found = read_event_tables(spark, "odd_days", "20240101", "20240104")
    assert found.count() == 4 + 3 + 2 + 4
    assert found.where("event_date = '20240102'").count() == 3


def test_scratch_space_of_a_cluster_is_shared(spark, monkeypatch):
    class Elsewhere:
        class sparkContext:  # noqa: N801
            master = "spark://somewhere:7077"

        class conf:  # noqa: N801
            settings = {"spark.sql.warehouse.dir": "file:/home/driver/spark-warehouse"}

            @classmethod
            def get(cls, key, default=None):
                return cls.settings.get(key, default)

    with pytest.raises(ValueError, match="all executors share"):
        scratch.scratch_root(Elsewhere)
    Elsewhere.conf.settings = {"spark.sql.warehouse.dir": "hdfs://x/warehouse"}
    assert scratch.scratch_root(Elsewhere) == "hdfs://x/warehouse/_scratch"
    Elsewhere.conf.settings = {"spark.checkpoint.dir": "file:/shared/dir/"}
    assert scratch.scratch_root(Elsewhere) == "file:/shared/dir"


def test_an_empty_refresh_keeps_the_columns(spark, records, tmp_path):
    steps, summary = str(tmp_path / "steps"), str(tmp_path / "summary")
    refresh_marts(records, steps, summary)
    full = read_mart(spark, summary)
    assert full.count() > 0
    refresh_marts(records.where("false"), steps, summary)
    assert read_mart(spark, summary, schema=full.schema).count() == 0


def test_a_mart_is_rebuilt_when_it_is_old(spark, tmp_path):
    path, made = str(tmp_path / "mart"), []

    def refresh():
        made.append(len(made))
        write_funnel_steps(facts(spark, 10 * len(made)), path)

    assert version_age(spark, path) is None
    assert fresh_mart(spark, path, refresh).count() == 10
    assert 0 <= version_age(spark, path) < 600
    kept = fresh_mart(spark, path, refresh)
    assert kept.count() == 10 and made == [0]
    assert fresh_mart(spark, path, refresh, max_age=0).count() == 20
    assert kept.count() == 10
    (pointer,) = glob.glob(f"{path}/_published/*2.*")
    os.utime(pointer, (time.time() - 3700,) * 2)
    assert version_age(spark, path) > 3600
    assert fresh_mart(spark, path, refresh, max_age=4000).count() == 20
    assert fresh_mart(spark, path, refresh).count() == 30 and made == [0, 1, 2]


def test_a_failed_rebuild_of_an_old_mart_is_told(spark, tmp_path):
    path = str(tmp_path / "mart")
    write_funnel_steps(facts(spark, 60), path)
    with pytest.raises(PySparkException, match="killed midway"):
        fresh_mart(spark, path, lambda: write_funnel_steps(failing(facts(spark, 100)), path), 0)
    assert read_mart(spark, path).count() == 60


def test_a_table_is_written_for_each_day(spark, records, tmp_path):
    spark.sql("create database if not exists written_days")
    days = [F.lit(f"2024010{i}") for i in (1, 2, 3)]
    rows = records.limit(4).withColumn("event_date", F.explode(F.array(*days)))
    rows = rows.withColumn("odd name`s", F.lit(1))
    made = write_event_tables(rows, "written_days", str(tmp_path / "it's"))
    assert made == ["events_20240101", "events_20240102", "events_20240103"]
    assert read_event_tables(spark, "written_days", "20240102", "20240103").count() == 8
    assert spark.table("written_days.events_20240101").schema.names == rows.schema.names
    assert write_event_tables(rows.where("false"), "written_days", str(tmp_path / "none")) == []
    odd = rows.withColumn("event_date", F.lit(None).cast("string"))
    with pytest.raises(ValueError, match="no day"):
        write_event_tables(odd, "written_days", str(tmp_path / "odd"), "odd_")
    assert described_tables(spark, "written_days", "odd_") == []
