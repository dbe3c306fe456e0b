from __future__ import annotations

from pyspark.sql import functions as F

from postgrain.operators import cleaning, profile, rollups
from tests.data import bag, post, posts


def test_clean_posts_derives_and_drops(spark):
    raw = posts(spark, [
        post(1, " Ann\t"), post(2, None), post(3, "  \n "),
        post(4, "bob", likes=None, followers=0, date="bad", description=None, post_type=None),
    ])
    rows = {r["sid"]: r for r in cleaning.clean_posts(raw).collect()}
    assert set(rows) == {1, 4}
    assert rows[1]["username"] == "ann"
    assert rows[1]["engagement_rate"] == 0.12
    assert (rows[1]["post_year"], rows[1]["post_month"], rows[1]["post_hour"]) == (2019, 3, 5)
    assert rows[4]["engagement"] == 2.0
    assert rows[4]["engagement_rate"] is None
    assert rows[4]["post_date"] is None
    assert rows[4]["description"] == ""
    assert rows[4]["post_type_label"] == "Post Type 2"


def test_clean_posts_tolerates_missing_columns(spark):
    raw = posts(spark, [post(1)]).drop("bio", "description", "post_type", "followers")
    got = cleaning.clean_posts(raw).columns
    assert "post_type_label" not in got and "engagement_rate" not in got
    assert "engagement" in got


def hot_posts(spark):
    """A third of the rows share one sid; some of its rows are exact copies."""
    rows = [post(7, f"u{i % 5}", date=f"2019-01-01 00:00:{59 - i % 50:02d}", likes=i % 9)
            for i in range(200)]
    rows += [post(1000 + i, f"u{i}") for i in range(400)]
    return posts(spark, rows)


def test_dedup_keeps_the_earliest_readable_date(spark):
    raw = posts(spark, [
        post(1, "late", date="2019-05-01 00:00:00"), post(1, "early", date="2019-01-01 00:00:00"),
        post(1, "bad", date="bad"), post(2, "only", date="bad"), post(None, "x"), post(None, "y"),
    ])
    got = {(r["sid"], r["username"]) for r in cleaning.dedup_posts(raw).collect()}
    assert got == {(1, "early"), (2, "only"), (None, "x"), (None, "y")}


def test_metrics_that_are_no_finite_number_are_null(spark):
    df = spark.createDataFrame([("NaN",), ("Infinity",), ("-Infinity",), ("x",), ("1e3",)], "likes string")
    got = [r["likes"] for r in cleaning.with_metric_doubles(df, ["likes"]).collect()]
    assert got == [None, None, None, None, 1000.0]
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (2.0,)], "likes double")
    assert [r["likes"] for r in cleaning.with_metric_doubles(df, ["likes"]).collect()] == [None, None, 2.0]


def test_dedup_does_not_depend_on_partitioning(spark):
    raw = hot_posts(spark)
    want = bag(cleaning.dedup_posts(raw.repartition(1)))
    assert len(want) == 401
    for n in (4, 9):
        assert bag(cleaning.dedup_posts(raw.repartition(n))) == want


def test_clean_stats_agree_with_the_cleaned_frame(spark):
    raw = hot_posts(spark).union(posts(spark, [
        post(5000, None), post(5001, " "), post(5002, "z", date="bad"), post(None, "n"),
        post(5003, None), post(5003, "kept"), post(None, "m", date="bad"), post(None, None),
    ]))
    clean = cleaning.clean_posts(raw, dedup=True).collect()
    stats = cleaning.clean_stats(raw).first().asDict()
    assert stats["rows_before"] == 608
    assert stats["unusable_users_removed"] == 4
    assert stats["rows_after"] == len(clean) == 405
    assert stats["duplicate_sids_removed"] == 608 - 4 - 405
    assert stats["rows_without_id"] == 2
    assert stats["distinct_sids"] == len({r["sid"] for r in clean if r["sid"] is not None})
    assert stats["null_dates"] == sum(r["post_date"] is None for r in clean) == 2
    assert stats["column_count"] == len(cleaning.clean_posts(raw).columns)


def test_clean_stats_of_an_empty_frame(spark):
    stats = cleaning.clean_stats(posts(spark, [])).first()
    assert stats["rows_before"] == stats["rows_after"] == stats["duplicate_sids_removed"] == 0


LEGACY = (
    "post_id string, user_posted string, content_type string, likes string, num_comments string, "
    "date_posted string, location string"
)


def legacy(spark):
    return spark.createDataFrame([
        ("12345678901234567890", " Ann ", "Image", "1,000", "5", "2019-03-04T05:06:07.000Z", None),
        ("002", "bob", "Video", "7", None, "2019-03-04 05:06:07 UTC", "  "),
        ("002", "bob", "Video", "8", None, "2019-03-04 05:06:07", " Paris "),
        ("3", "  ", "Video", "9", "1", "bad", "Rome"),
    ], LEGACY)


def test_clean_stats_of_the_legacy_layout(spark):
    clean = cleaning.clean_legacy(legacy(spark))
    stats = cleaning.clean_stats(legacy(spark)).first().asDict()
    assert stats == {
        "rows_before": 4, "unusable_users_removed": 1, "duplicate_sids_removed": 1, "rows_after": 2,
        "distinct_sids": 2, "rows_without_id": 0, "null_dates": 0, "column_count": len(clean.columns),
    }


def test_clean_legacy(spark):
    rows = {r["post_id"]: r for r in cleaning.clean_legacy(legacy(spark)).collect()}
    assert set(rows) == {"12345678901234567890", "002"}
    long_id = rows["12345678901234567890"]
    assert (long_id["likes"], long_id["engagement"], long_id["location"]) == (None, 5.0, "Unknown")
    assert (rows["002"]["likes"], rows["002"]["engagement_total"]) == (7.0, 7.0)
    assert rows["002"]["post_year"] == 2019


def test_legacy_under_primary_names_feeds_the_reports(spark):
    posts_ = cleaning.to_canonical(cleaning.clean_legacy(legacy(spark)))
    summary = rollups.overall_summary(posts_, exact_medians=True).first()
    assert (summary["total_posts"], summary["unique_users"]) == (2, 2)
    assert summary["avg_engagement"] == 6.0
    assert "avg_followers" not in summary.asDict()


def test_profiles(spark):
    raw = posts(spark, [post(1, "A"), post(2, "a", likes=None), post(3, None, comments=None)])
    assert tuple(profile.overview(raw).first()) == (3, 16, 3)  # A, a and a missing one
    assert profile.source_nulls(raw).first().asDict() == {
        "null_username": 1, "null_likes": 1, "null_comments": 1, "null_followers": 0,
    }
    clean = cleaning.clean_posts(raw)
    wide = profile.quality_summary(clean).first().asDict()
    assert (wide["total_posts"], wide["null_likes"], wide["null_post_date"]) == (2, 1, 0)
    long = {r["column_name"]: r["null_count"] for r in profile.quality_long(clean).collect()}
    assert long == {k[5:]: v for k, v in wide.items() if k != "total_posts"}


def test_preview_prints_at_most_ten_rows(spark, capsys):
    profile.preview(spark.range(50).select(F.col("id").cast("string").alias("row")), 30)
    table = [line for line in capsys.readouterr().out.splitlines() if line.startswith("|")]
    assert len(table) == 1 + 10  # header and rows
