from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from postgrain.operators import cleaning, quantiles, rollups, slices, topk
from postgrain.operators.quantiles import discrete_quantiles
from tests.data import bag, post, posts


def discrete(values, q):
    values = sorted(v for v in values if v is not None)
    rank = max(1, -(-int(q * 1000) * len(values) // 1000))
    return values[rank - 1]


@pytest.mark.parametrize("q", [0.0, 0.25, 0.5, 0.9, 1.0])
@pytest.mark.parametrize("buckets", [1, 2, 65_536])
def test_quantiles_equal_a_sort(spark, q, buckets):
    rng = random.Random(7)
    rows = [(
        rng.choice([0.0, 0.0, 0.0, rng.randrange(10**9) * 1.0]),  # most values equal, long tail
        rng.choice([None, rng.uniform(-5, 5)]),
        3.0,
    ) for _ in range(500)]
    df = spark.createDataFrame(rows, "a double, b double, c double").repartition(5)
    got = discrete_quantiles(df, ["a", "b", "c"], q, buckets=buckets).first()
    assert list(got) == [discrete(col, q) for col in zip(*rows)]


def test_an_outlier_leaves_few_values_to_rank(spark):
    """300,000 different values in [0, 1) and one of 1e12."""
    n = 300_000
    df = spark.range(n).select((F.col("id") * 7919 % n / n).alias("a")).union(spark.createDataFrame([(1e12,)], "a double"))
    counts = quantiles.value_counts(df, ["a"])
    ranked = counts.withColumn("rank", F.lit(n // 2 + 1))
    left = quantiles._narrowed(ranked, F.asinh, quantiles.HISTOGRAM_BUCKETS)
    assert left.count() < 200
    assert discrete_quantiles(df, ["a"], 0.5).first()[0] == 0.5


def test_quantiles_of_nothing_are_null(spark):
    df = spark.createDataFrame([(None, None)], "a double, b double")
    assert tuple(discrete_quantiles(df, ["a", "b"], 0.5).first()) == (None, None)


def some_posts(spark, n=600, seed=3):
    rng = random.Random(seed)
    return posts(spark, [post(
        i, f"user{rng.randrange(60)}",
        likes=rng.choice([None, rng.randrange(1000)]), comments=rng.choice([None, rng.randrange(9)]),
        post_type=rng.choice([1, 2, None]), is_business_account=rng.choice([True, False, None]),
        description_category=rng.choice(["food", "art", "pets", None]),
        followers=rng.choice([0, 10, 1000]), date=f"201{rng.randrange(5)}-0{rng.randrange(1, 9)}-07 01:02:03",
    ) for i in range(n)])


@pytest.fixture(scope="module")
def clean(spark):
    return cleaning.clean_posts(some_posts(spark)).cache()


def test_approximate_medians_are_exact_on_few_values(clean):
    assert tuple(rollups.medians(clean).first()) == tuple(rollups.medians(clean, exact=True).first())


def test_overall_summary(clean):
    rows = clean.collect()
    got = rollups.overall_summary(clean, exact_medians=True).first()
    likes = [r["likes"] for r in rows if r["likes"] is not None]
    assert got["total_posts"] == len(rows)
    assert got["unique_users"] == len({r["username"] for r in rows})
    assert got["avg_likes"] == pytest.approx(sum(likes) / len(likes))
    assert got["median_likes"] == discrete(likes, 0.5)
    assert got["business_post_count"] == sum(r["is_business_account"] is True for r in rows)
    assert got["non_business_post_count"] == sum(r["is_business_account"] is False for r in rows)


def test_month_axis_can_be_filled(clean):
    months = rollups.temporal_month(clean, fill=True).collect()
    assert [m["month"] for m in months] == list(range(1, 13))
    assert months[11]["post_count"] == 0 and months[11]["avg_engagement"] is None
    assert sum(m["post_count"] for m in months) == clean.count()


def test_largest_groups_come_first(clean):
    counts = [r["post_count"] for r in rollups.category_analysis(clean).collect()]
    assert counts == sorted(counts, reverse=True)


def test_ties_go_to_the_smaller_name(spark):
    tied = cleaning.clean_posts(posts(spark, [post(i, f"u{i:02d}") for i in range(40)]))
    for n in (1, 4, 9):
        got = [r["username"] for r in topk.top_users_by_engagement(tied.repartition(n)).collect()]
        assert got == [f"u{i:02d}" for i in range(15)]


def test_top_per_group_beyond_the_pruned_rank_is_the_same(spark):
    df = spark.range(5000).selectExpr("id", "if(id % 3 = 0, 'hot', 'cold') AS g", "(id * 7919) % 1000 AS v")
    order = [df.v.desc(), df.id]
    plain = bag(topk.top_per_group(df, ["g"], order, "id", 900))
    spark.conf.set(topk.PRUNED_RANK, "10")
    try:
        assert bag(topk.top_per_group(df, ["g"], order, "id", 900)) == plain
    finally:
        spark.conf.unset(topk.PRUNED_RANK)


# ---------------------------------------------------------------- slices
def matches(row, selection):
    return all(v is None or row[d] == v for d, v in selection.items())


SELECTIONS = [
    {}, {"post_type_label": "Post Type 1"}, {"is_business_account": False},
    {"description_category": "food", "is_business_account": True},
    {"description_category": "no such category"},
]


@pytest.mark.parametrize("selection", SELECTIONS)
def test_slice_kpis_equal_averages_over_the_posts(clean, selection):
    rows = [r for r in clean.collect() if matches(r, selection)]
    got = slices.slice_kpis(slices.filter_cube(clean), selection).first()
    assert got["post_count"] == len(rows)
    for name, column in (("likes", "likes"), ("rate", "engagement_rate"), ("followers", "followers")):
        values = [r[column] for r in rows if r[column] is not None]
        want = pytest.approx(sum(values) / len(values)) if values else None
        assert got[f"avg_{name}"] == want


def test_cube_total_equals_the_overall_summary(clean):
    total = slices.slice_kpis_cube(slices.filter_cube(clean)).filter(
        "all_post_type_label AND all_is_business_account AND all_description_category"
    ).first()
    summary = rollups.overall_summary(clean).first()
    assert total["post_count"] == summary["total_posts"]
    assert total["avg_likes"] == pytest.approx(summary["avg_likes"])
    assert total["avg_rate"] == pytest.approx(summary["avg_engagement_rate"])


def test_unique_users_equal_a_distinct_count_per_selection(clean):
    rows = clean.collect()
    dims = ["post_type_label", "is_business_account", "description_category"]
    want = {}
    for mask in range(8):
        for r in rows:
            key = tuple(
                ("all", None) if mask >> i & 1 else ("is", r[d]) for i, d in enumerate(dims)
            )
            want.setdefault(key, set()).add(r["username"])
    got = {
        tuple(("all", None) if r[f"all_{d}"] else ("is", r[d]) for d in dims): r["unique_users"]
        for r in slices.slice_unique_users(clean).collect()
    }
    assert got == {k: len(v) for k, v in want.items()}


def test_slice_top_users_finds_users_spread_over_cells(spark):
    rows, sid = [], 0
    for category in ("a", "b", "c"):
        for rank in range(15):
            rows.append(post(sid := sid + 1, f"{category}{rank:02d}", likes=100, comments=0,
                             description_category=category))
        rows.append(post(sid := sid + 1, "spread", likes=99, comments=0,
                         description_category=category))
    clean = cleaning.clean_posts(posts(spark, rows))
    assert "spread" not in {r["username"] for r in topk.top_users_cube(clean).collect()}
    first = slices.slice_top_users(clean, {"post_type_label": "Post Type 1"}).first()
    assert (first["username"], first["total_engagement"]) == ("spread", 297.0)


def test_unfiltered_slice_top_users_are_the_overall_ones(clean):
    assert bag(slices.slice_top_users(clean, {})) == bag(topk.top_users_by_engagement(clean))


def test_charts_ignore_their_own_dimension(clean):
    cube = slices.filter_cube(clean)
    selection = {"post_type_label": "Post Type 1", "is_business_account": True}
    types = slices.slice_posts_by_type(cube, selection)
    assert {r["post_type_label"] for r in types.collect()} == {"Post Type 1", "Post Type 2"}
    accounts = slices.slice_engagement_by_business(cube, selection).collect()
    assert [r["account"] for r in accounts] == ["Business", "Non-business"]
    categories = slices.slice_posts_by_category(cube, selection).collect()
    assert None not in {r["description_category"] for r in categories}


def test_facets_are_sorted_and_limited_on_demand(clean):
    cube = slices.filter_cube(clean)
    labels = [("post_type_label", "Post Type 1"), ("post_type_label", "Post Type 2")]
    names = [("description_category", c) for c in ("art", "food", "pets")]
    assert [tuple(r) for r in slices.facet_values(cube).collect()] == names + labels
    assert [tuple(r) for r in slices.facet_values(cube, categories=2).collect()] == names[:2] + labels


def test_all_categories_are_offered(spark):
    many = cleaning.clean_posts(posts(spark, [post(i, description_category=f"c{i % 100:02d}") for i in range(200)]))
    got = slices.facet_values(slices.filter_cube(many)).filter("facet = 'description_category'")
    assert [r["choice"] for r in got.collect()] == [f"c{i:02d}" for i in range(100)]
