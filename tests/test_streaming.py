from __future__ import annotations

import datetime as dt

import pytest

from postgrain.streaming import daily

SCHEMA = "at timestamp, kind string, value double"


def event(day, kind="a", value=1.0, hour=5):
    return (dt.datetime(2024, 1, day, hour), kind, value)


def write(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def run(spark, src, tmp_path):
    stream = daily.daily(daily.read_events(spark, src, SCHEMA, files_per_batch=1), "at", "kind", "value")
    return daily.run_available(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint"))


def rows_of(df):
    return sorted((str(r["day"]), r["kind"], r["posts"], r["total"], r["values"]) for r in df.collect())


@pytest.fixture
def fewer_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_finite_run_restart_and_late_rows(spark, tmp_path, fewer_partitions):
    src = str(tmp_path / "src")
    first = [event(1), event(1, value=None), event(2, "b", 2.5), (None, "a", 1.0)]
    second = [event(1, value=4.0), event(9), event(9, "b")]
    write(spark, src, first)
    write(spark, src, second)
    query = run(spark, src, tmp_path)
    batch = daily.daily(spark.read.parquet(src), "at", "kind", "value", None)
    assert rows_of(daily.latest(spark, str(tmp_path / "out"))) == rows_of(batch)
    assert daily.late_rows(query) == 0
    # Nothing new: a restart changes nothing.
    run(spark, src, tmp_path)
    assert rows_of(daily.latest(spark, str(tmp_path / "out"))) == rows_of(batch)
    # Day 2 is behind the watermark, which is day 9 less two days; day 8 is not.
    write(spark, src, [event(2, "b", 100.0), event(8, "a", 3.0), event(9, "a", 5.0)])
    query = run(spark, src, tmp_path)
    within = spark.createDataFrame(first + second + [event(8, "a", 3.0), event(9, "a", 5.0)], SCHEMA)
    assert rows_of(daily.latest(spark, str(tmp_path / "out"))) == rows_of(daily.daily(within, "at", "kind", "value", None))
    assert daily.late_rows(query) == 1


def test_no_events(spark, tmp_path):
    src = str(tmp_path / "src")
    write(spark, src, [])
    run(spark, src, tmp_path)
    assert rows_of(daily.latest(spark, str(tmp_path / "out"))) == []
