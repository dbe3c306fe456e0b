from __future__ import annotations

import pytest

from postgrain.operators import cell_sample, cleaning, sketches, slices
from postgrain.plans.queries import CELL_COLUMNS
from tests.data import post, posts
from tests.test_userlists import corpus


@pytest.fixture(scope="module")
def clean(spark):
    return cleaning.clean_posts(posts(spark, corpus(seed=8, n=1200, users=300)))


def test_small_selections_are_all_but_exact(clean):
    built = sketches.cell_sketches(clean)
    for selection in ({}, {"is_business_account": True}, {"description_category": "art", "post_type_label": "Post Type 1"}):
        rows = slices.select_slice(clean, selection)
        got = sketches.slice_estimates(built, selection).first()
        users = rows.select("username").distinct().count()
        assert abs(got["unique_users"] - users) <= 1 + users * 5 * sketches.USER_ERROR
        likes = sorted(r[0] for r in rows.select("likes").dropna().collect())
        place = sum(v < got["median_likes"] for v in likes), sum(v <= got["median_likes"] for v in likes)
        slack = 2 * sketches.RANK_ERROR * len(likes) + 1
        assert place[0] <= len(likes) / 2 + slack and place[1] >= len(likes) / 2 - slack


def test_nothing_selected(clean):
    built = sketches.cell_sketches(clean)
    got = sketches.slice_estimates(built, {"description_category": "none"}).first()
    assert got["median_likes"] is None and not got["unique_users"]


def test_stored_sketches_answer_without_the_posts(spark, clean, tmp_path):
    sketches.cell_sketches(clean).write.parquet(str(tmp_path / "s"))
    built = spark.read.parquet(str(tmp_path / "s"))
    assert sketches.slice_estimates_cube(built).count() == slices.slice_unique_users(clean).count()


def test_small_cells_are_complete_and_weights_add_up(spark, clean):
    sample = cell_sample.cell_sample(clean, CELL_COLUMNS, 30)
    cells = {tuple(r[:3]): r[3] for r in clean.groupBy(*slices.SLICE_DIMS).count().collect()}
    drawn = {}
    for r in sample.collect():
        drawn.setdefault(tuple(r[d] for d in slices.SLICE_DIMS), []).append(r["weight"])
    assert set(drawn) == set(cells)
    for cell, n in cells.items():
        assert len(drawn[cell]) == min(n, 30) and sum(drawn[cell]) == pytest.approx(n)
    got = cell_sample.estimated_posts(sample, {"is_business_account": False}).first()[0]
    assert got == pytest.approx(clean.filter("NOT is_business_account").count())


def test_copies_are_drawn_one_by_one(spark):
    rows = [post(1, "a")] * 1500 + [post(i, "b") for i in range(2, 502)]
    sample = cell_sample.cell_sample(cleaning.clean_posts(posts(spark, rows)), CELL_COLUMNS, 400)
    copies = sample.filter("username = 'a'").count()
    assert sample.count() == 400 and 250 < copies < 350


def test_samples_of_parts_merge(spark):
    rows = [r for r in corpus(seed=2, n=600)]
    clean = cleaning.clean_posts(posts(spark, rows))
    parts = [cell_sample.cell_sample(clean.filter(f"sid % 3 = {i}"), CELL_COLUMNS, 20) for i in range(3)]
    merged = cell_sample.merge_samples(parts[0].unionByName(parts[1]).unionByName(parts[2]), 20)
    whole = cell_sample.cell_sample(clean, CELL_COLUMNS, 20)
    key = lambda r: (r["sid"], r["digest"], round(r["weight"], 6))
    assert sorted(map(key, merged.collect())) == sorted(map(key, whole.collect()))
