"""Physical plans: what must hold for the queries to run on very large tables."""

from __future__ import annotations

import re

import pytest

from postgrain.operators import bloom, cleaning, rollups, sampling, slices, topk
from postgrain.plans.queries import QUERIES
from tests.data import post, posts

SF_DIR = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("posts") / "raw")
    posts(spark, [post(i, f"u{i % 9}") for i in range(90)]).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def clean(stored):
    return cleaning.clean_posts(stored)


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_query_pairs_rows_or_runs_python(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "InPandas"):
        assert bad not in text


def read_columns(df) -> list[set[str]]:
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan(df))
    return [{c.split(":")[0] for c in s.split(",") if c} for s in schemas]


def test_reports_read_only_their_columns(clean):
    assert read_columns(rollups.language_analysis(clean)) == [{"username", "lang"}]
    assert read_columns(topk.top_users_by_posts(clean)) == [{"username"}]
    assert read_columns(topk.top_users_by_likes(clean)) == [{"username", "likes"}]
    assert read_columns(rollups.temporal_month(clean)) == [
        {"username", "date", "likes", "comments"}
    ]


def test_slice_filters_reach_the_scan(clean):
    cube = slices.filter_cube(clean)
    text = plan(slices.slice_kpis(cube, {"description_category": "food"}))
    assert "EqualTo(description_category,food)" in text


def test_overall_counts_read_the_posts_once(clean):
    assert plan(rollups.overall_counts(clean)).count("FileScan parquet") == 1


def test_hot_keys_are_cut_before_the_shuffle(stored, clean):
    for df in (cleaning.dedup_posts(stored), topk.top_users_cube(clean)):
        text = plan(df)
        partial = text.index("Partial", text.index("Exchange hashpartitioning"))
        assert "WindowGroupLimit" in text[:partial]


def test_top_users_need_no_global_sort(clean):
    text = plan(topk.top_users_by_engagement(clean))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_unique_users_per_slice_take_one_shuffle_by_user(clean):
    text = plan(slices.slice_unique_users(clean))
    by = re.findall(r"Exchange hashpartitioning\((\w+)", text)
    # By user, then only counts: per set of cells and per selection.
    assert by[:2] == ["post_type_label", "cells"] and set(by[2:]) == {"username"}
    # Sets are made of distinct pairs: no row of the posts reaches the aggregate that may sort.
    assert "HashAggregate" in text[text.rindex("collect_list"):]
    assert "Expand" not in text


def executed(df) -> str:
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


def test_samples_and_facets_read_the_posts_once(clean):
    for df in (sampling.engagement_sample(clean), slices.facet_values(slices.filter_cube(clean))):
        assert plan(df).count("FileScan parquet") == 1


def test_filter_and_parameters_share_one_distinct_user_set(stored):
    users = bloom.distinct_users(stored)
    params = bloom.bloom_params(users)
    assert "ReusedExchange" in executed(bloom.bloom_words(users, params))


def test_the_cell_sample_derives_its_posts_once(spark):
    """Digests, rows drawn and cells are read from stored posts, not from three joins of the tables."""
    assert "l_orderkey" not in plan(QUERIES["cell_sample"](spark, SF_DIR))
