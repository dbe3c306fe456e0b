from __future__ import annotations

import collections
import hashlib

import pytest
from pyspark.sql import functions as F

from postgrain.operators import charts, cleaning, explorer, sampling
from tests.data import bag, post, posts


@pytest.fixture(scope="module")
def clean(spark):
    rows = [post(i, f"u{i % 50}", date=f"2019-01-01 00:{i % 60:02d}:00", likes=i % 40) for i in range(2000)]
    return cleaning.clean_posts(posts(spark, rows)).cache()


def digests(df):
    """(digest, sid) of every row, from its values and its number among equal rows."""
    seen, out = collections.Counter(), []
    for r in df.collect():
        text = "|".join(
            f"{v:.6f}" if isinstance(v, float) else str(v).lower() if isinstance(v, bool) else str(v)
            for v in r if v is not None
        )
        out.append((hashlib.md5(f"{text}|{seen[text]}".encode()).hexdigest(), r["sid"]))
        seen[text] += 1
    return sorted(out)


def test_sample_is_the_rows_below_the_threshold(clean):
    columns = ["sid", "date", "username", *sampling.SAMPLE_REQUIRED, *sampling.SAMPLE_OPTIONAL]
    want = sorted(sid for d, sid in digests(clean.select(*columns)) if d < "19999999")
    got = sampling.engagement_sample(clean, fraction=0.1, extra=("sid",)).collect()
    assert sorted(r["sid"] for r in got) == want
    assert 100 < len(want) < 300


def test_cap_keeps_the_smallest_digests(clean):
    got = sampling.explorer_sample(clean, cap=300).collect()
    assert sorted(r["sid"] for r in got) == sorted(sid for _, sid in digests(clean)[:300])


def test_a_repeated_post_is_drawn_copy_by_copy(spark):
    """100,000 posts of one id, date and user: equal in all columns, or with different likes."""
    one = cleaning.clean_posts(posts(spark, [post(1)]))
    for likes in (F.lit(5.0), F.col("id") % 7):
        many = one.drop("likes").join(spark.range(100_000)).withColumn("likes", likes.cast("double"))
        n = sampling.engagement_sample(many).count()
        assert 800 < n < 1200
        assert sampling.engagement_sample(many.repartition(3)).count() == n


def test_the_sample_has_no_cap(clean):
    assert sampling.engagement_sample(clean, fraction=1).count() == 2000


@pytest.mark.parametrize("cap", [1, 37, 1999, 2000, 5000])
def test_sample_size(clean, cap):
    assert sampling.explorer_sample(clean, cap).count() == min(cap, 2000)


def test_sample_does_not_depend_on_partitioning(clean):
    want = bag(sampling.engagement_sample(clean, fraction=0.5, cap=200))
    for n in (1, 4, 9):
        assert bag(sampling.engagement_sample(clean.repartition(n), fraction=0.5, cap=200)) == want


def test_copies_of_a_row_keep_their_number(spark):
    """A third of the rows are copies of one row."""
    rows = [post(1)] * 300 + [post(10 + i) for i in range(600)]
    clean = cleaning.clean_posts(posts(spark, rows).repartition(7))
    order = digests(clean)
    for cap in (5, 400, 700, 900, 1000):
        got = collections.Counter(r["sid"] for r in sampling.explorer_sample(clean, cap).collect())
        assert got == collections.Counter(sid for _, sid in order[:cap])


def test_only_posts_that_may_be_drawn_are_grouped_whole(spark, clean, monkeypatch):
    """600 distinct posts and 300 copies of one: the copies, and as many others as are drawn."""
    seen, grouped = [], sampling._each_copy
    monkeypatch.setattr(sampling, "_each_copy", lambda rows, *keep: seen.append(rows.count()) or grouped(rows, *keep))
    assert sampling.explorer_sample(clean, 300).count() == 300
    rows = [post(1)] * 300 + [post(10 + i) for i in range(600)]
    assert sampling.explorer_sample(cleaning.clean_posts(posts(spark, rows)), 50).count() == 50
    assert seen[0] == 300 and 349 <= seen[1] <= 350


def test_empty_input(clean):
    assert sampling.explorer_sample(clean.limit(0), 10).count() == 0


# ---------------------------------------------------------------- explorer
def test_pages_cover_the_matching_rows_once(clean):
    sample = sampling.explorer_sample(clean, 500)
    pages = [
        [tuple(r) for r in explorer.explorer_page(
            sample, {"post_type_label": "Post Type 1"}, page=p, size=200).collect()]
        for p in range(4)
    ]
    assert [len(p) for p in pages] == [200, 200, 100, 0]
    assert len({row for p in pages for row in p}) == 500


def test_page_search_and_filters(clean):
    sample = sampling.explorer_sample(clean, 2000)
    hits = explorer.explorer_page(sample, {}, {"username": "U4", "likes": "7"}, size=1000).collect()
    assert hits and all("u4" in r["username"] and "7" in str(r["likes"]) for r in hits)
    assert "post_month" not in hits[0].asDict()
    none = explorer.explorer_match_count(sample, {"is_business_account": True}).first()
    assert tuple(none) == (0, 2000)


def test_explorer_pages_through_all_posts(clean):
    many = clean.drop("sid").join(spark_range(clean, 15)).withColumn("sid", F.col("id"))
    assert many.count() == 30_000
    assert explorer.explorer_page(many, {}, page=100, size=100).count() == 100
    assert explorer.explorer_page(many, {}, page=299, size=100).count() == 100
    assert explorer.explorer_page(many, {}, page=300, size=100).count() == 0
    assert explorer.explorer_page(many, {}, size=20_000).count() == 20_000


def spark_range(df, n):
    return df.sparkSession.range(n)


# ---------------------------------------------------------------- grade bins
def grades(spark, values, likes=None):
    rows = [(v, float(i) if likes is None else likes) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "image_grade double, likes double")


def test_bins_are_closed_on_the_right(spark):
    values = [i / 10 for i in range(11)] * 10
    got = charts.grade_bins(grades(spark, values), "image_grade").collect()
    # 0.0 and 0.1 share the first bin; every later edge belongs to the bin below it.
    assert [r["post_count"] for r in got] == [20] + [10] * 9
    assert [r["bin"] for r in got] == list(range(1, 11))
    assert got[-1]["upper_edge"] == 1.0


def test_bins_without_a_spread(spark):
    got = charts.grade_bins(grades(spark, [0.4] * 60, likes=3.0), "image_grade").collect()
    assert [(r["post_count"], r["mean_likes"]) for r in got] == [(60, 3.0)]


def test_few_rows_are_binned_unless_a_least_number_is_asked_for(spark):
    few = grades(spark, [0.1, 0.2] * 24 + [0.2])
    assert [r["post_count"] for r in charts.grade_bins(few, "image_grade").collect()] == [24, 25]
    assert charts.grade_bins(few, "image_grade", min_rows=50).count() == 0
    assert charts.grade_bins(grades(spark, [None, None]), "image_grade").count() == 0


def test_scatter_points(spark):
    rows = [post(1, followers=0), post(2, followers=1000, likes=99, comments=0),
            post(3, followers=10, likes=None, comments=0)]
    clean = cleaning.clean_posts(posts(spark, rows))
    likes = charts.followers_vs_likes(clean).collect()
    assert [(r["log_followers"], r["log_likes"]) for r in likes] == [(pytest.approx(3), pytest.approx(2))]
    assert charts.followers_vs_engagement(clean).count() == 2
