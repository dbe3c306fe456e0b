from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from postgrain.operators import cleaning, rollups
from postgrain.plans import report
from postgrain.sources import readers, sinks
from tests.data import bag, post, posts

CSV_TEXT = (
    'post_id,user_posted,description\n'
    '12345678901234567890,ann,"two\nlines, a comma and ""quotes"""\n'
    '007,  bob  ,\n'
)


def test_legacy_csv_keeps_text_as_it_is(spark, tmp_path):
    (tmp_path / "posts.csv").write_text(CSV_TEXT)
    rows = readers.read_legacy_csv(spark, str(tmp_path / "posts.csv")).collect()
    assert tuple(rows[0]) == ("12345678901234567890", "ann", 'two\nlines, a comma and "quotes"')
    assert tuple(rows[1]) == ("007", "  bob  ", None)


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([
        ("001", ' lead "and" trail ', 'a\nb'), ("12345678901234567890", None, "x,y"),
    ], "post_id string, user_posted string, description string")
    sinks.write_csv(df.repartition(2), str(tmp_path / "out"))
    sinks.write_csv(df, str(tmp_path / "out"))  # replaces, does not append
    assert bag(readers.read_clean_csv(spark, str(tmp_path / "out"), df.schema)) == bag(df)
    assert bag(readers.read_legacy_csv(spark, str(tmp_path / "out"))) == bag(df)


def test_open_posts_prefers_the_primary_table(spark, tmp_path):
    parquet, csv = str(tmp_path / "p"), str(tmp_path / "posts.csv")
    (tmp_path / "posts.csv").write_text(CSV_TEXT)
    kind, df = readers.open_posts(spark, parquet, csv)
    assert (kind, df.columns) == ("fallback", ["post_id", "user_posted", "description"])
    posts(spark, [post(2**62 + 1)]).write.parquet(parquet)
    kind, df = readers.open_posts(spark, parquet, csv)
    assert (kind, df.first()["sid"]) == ("primary", 2**62 + 1)


def test_missing_input_is_an_error(spark, tmp_path):
    with pytest.raises(AnalysisException, match="absent.csv"):
        readers.open_posts(spark, str(tmp_path / "absent"), str(tmp_path / "absent.csv"))


def test_views(spark):
    readers.register_views(posts(spark, [post(1), post(2)]), "posts", "all_posts")
    assert spark.sql("SELECT count(*) FROM posts JOIN all_posts USING (sid)").first()[0] == 2


def test_clean_posts_are_stored_by_year(spark, tmp_path):
    clean = cleaning.clean_posts(posts(spark, [
        post(1), post(2, date="2018-01-01 00:00:00"), post(3, date="bad"),
    ]))
    sinks.save_clean_posts(clean, str(tmp_path / "clean"))
    stored = readers.read_posts(spark, str(tmp_path / "clean"))
    assert bag(stored.select(*clean.columns)) == bag(clean)
    plan = stored.filter("post_year = 2018")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(post_year" in plan


def test_posts_are_not_shuffled_to_be_stored(spark, tmp_path):
    """Each of the three tasks writes its own posts into the years it holds."""
    rows = [post(i, date=f"201{i % 2}-01-01 00:00:00") for i in range(300)]
    posts(spark, rows).repartition(3).write.parquet(str(tmp_path / "raw"))
    clean = cleaning.clean_posts(spark.read.parquet(str(tmp_path / "raw"))).withColumn("task", F.spark_partition_id())
    tasks = clean.select("task").distinct().count()
    sinks.save_clean_posts(clean, str(tmp_path / "clean"))
    assert tasks > 1
    for year in (2010, 2011):
        files = list((tmp_path / "clean" / f"post_year={year}").glob("*.parquet"))
        assert len(files) == tasks
        assert all(spark.read.parquet(str(f)).select("task").distinct().count() == 1 for f in files)
    assert readers.read_posts(spark, str(tmp_path / "clean")).count() == 300


def test_large_results_are_ordered_over_several_files(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        places = spark.range(100_000).select(
            F.format_string("place %06d", F.col("id") * 7919 % 100_000).alias("location"), F.lit(1.0).alias("engagement")
        )
        result = rollups.legacy_location_analysis(places)
        assert sinks.save_result(result, str(tmp_path), "places") == 100_000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = sorted((tmp_path / "places").glob("part-*.csv"))
    lines = [line for f in files for line in f.read_text().splitlines()[1:]]
    assert len(files) > 1
    assert [line.split(",")[0] for line in lines] == [f"place {i:06d}" for i in range(100_000)]


def test_result_is_one_file_and_counted(spark, tmp_path):
    df = spark.range(100).withColumn("half", F.col("id") / 2).orderBy(F.desc("id"))
    assert sinks.save_result(df, str(tmp_path), "numbers") == 100
    assert len(list((tmp_path / "numbers").glob("part-*.csv"))) == 1
    assert bag(readers.read_result(spark, str(tmp_path / "numbers"), df.schema)) == bag(df)
    assert readers.read_result(spark, str(tmp_path / "numbers")).count() == 100


def test_shared_folder_comes_from_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = (sinks.shared_folder(spark, "x") for _ in range(2))
    assert first.startswith(base) and first != second


def test_report_on_both_layouts(spark, tmp_path):
    raw = posts(spark, [
        post(i, f"u{i % 70}", likes=i % 50, image_grade=(i % 20) / 20) for i in range(400)
    ] + [post(1, "u1")])
    rows = report.run_report("primary", raw, str(tmp_path / "primary"))
    assert set(rows) == (
        {"clean_stats", "bloom_filter_results"} | set(report.CHARTS) | set(report.RESULTS)
    ) - {"legacy_content_analysis", "location_analysis"}
    assert rows["engagement_sample"] < 20
    summary = readers.read_result(spark, str(tmp_path / "primary/results/overall_summary")).first()
    assert (summary["total_posts"], summary["unique_users"]) == (400, 70)

    legacy = spark.createDataFrame(
        [(str(i), f"u{i % 9}", "Image", "5", "1", "2019-03-04 05:06:07", None) for i in range(60)],
        "post_id string, user_posted string, content_type string, likes string, "
        "num_comments string, date_posted string, location string",
    )
    rows = report.run_report("fallback", legacy, str(tmp_path / "legacy"))
    stats = readers.read_result(spark, str(tmp_path / "legacy/results/clean_stats")).first()
    assert (stats["rows_before"], stats["rows_after"]) == (60, 60)
    assert rows["location_analysis"] == rows["overall_summary"] == 1
    assert rows["top_users_by_engagement"] == 9
    assert "filter_cube" not in rows
