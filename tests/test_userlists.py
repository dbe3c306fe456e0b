from __future__ import annotations

import itertools

import numpy as np
import pytest

from postgrain.operators import cleaning, slices, userlists
from tests.data import post, posts
from tests.test_plans import plan

KINDS, ACCOUNTS, CATEGORIES = (1, 2), (True, False, None), ("food", "art", "sport", None)


def corpus(seed=4, n=1500, users=160):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        kind, account, category = (c[rng.integers(len(c))] for c in (KINDS, ACCOUNTS, CATEGORIES))
        likes = None if i % 13 == 0 else int(rng.zipf(1.6) % 5000)
        rows.append(post(i, f"u{int(rng.zipf(1.3)) % users}", post_type=kind, is_business_account=account, description_category=category, likes=likes))
    return rows


@pytest.fixture(scope="module")
def clean(spark):
    return cleaning.clean_posts(posts(spark, corpus()))


@pytest.fixture(scope="module")
def stored(spark, clean, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("lists"))
    userlists.save_lists(clean, path, head=5)
    return userlists.load_lists(spark, path)


def selections():
    choices = [
        [{}] + [{dim: v} for v in values if v is not None]
        for dim, values in zip(slices.SLICE_DIMS, (("Post Type 1", "Post Type 2"), ACCOUNTS, CATEGORIES), strict=True)
    ]
    return [a | b | c for a, b, c in itertools.product(*choices)]


def test_every_selection_equals_the_posts(clean, stored):
    for selection in selections()[::3]:
        got = userlists.top_users(*stored, selection, 7).collect()
        assert got == slices.slice_top_users(clean, selection, 7).collect(), selection


@pytest.mark.parametrize("k", [1, 60, 1000])
def test_any_number_of_users(clean, stored, k):
    assert userlists.top_users(*stored, {}, k).collect() == slices.slice_top_users(clean, {}, k).collect()


def test_a_user_below_every_head_is_found(spark, tmp_path):
    """Rank 3 in each of three cells, but first in their sum."""
    rows = [
        post(i, f"{name}{c}", description_category=c, likes=likes, comments=0)
        for c in ("a", "b", "c") for i, (name, likes) in enumerate([("first", 100), ("second", 90)])
    ]
    rows += [post(9, "steady", description_category=c, likes=80, comments=0) for c in ("a", "b", "c")]
    userlists.save_lists(cleaning.clean_posts(posts(spark, rows)), str(tmp_path), head=2)
    best = userlists.top_users(*userlists.load_lists(spark, str(tmp_path)), {}, 1).first()
    assert (best["username"], best["total_engagement"]) == ("steady", 240)


def test_totals_below_zero_and_ties(spark, tmp_path):
    rows = [post(i, f"u{i % 6}", description_category=c, likes=likes, comments=0) for i, (c, likes) in enumerate(
        [("a", 50), ("a", 50), ("a", 10), ("b", -45), ("b", 5), ("b", 5), ("a", 0), ("b", 0), ("a", -3), ("b", -70), ("a", 20), ("a", 20)]
    )]
    clean = cleaning.clean_posts(posts(spark, rows))
    userlists.save_lists(clean, str(tmp_path), head=1)
    lists = userlists.load_lists(spark, str(tmp_path))
    for k in (1, 2, 3, 6):
        assert userlists.top_users(*lists, {}, k).collect() == slices.slice_top_users(clean, {}, k).collect()


def test_lists_are_read_no_deeper_than_needed(stored):
    lists, heads = stored
    assert 0 < userlists.candidates(lists, heads, {}, 5).count() < lists.select("username").distinct().count() / 2
    text = plan(userlists.top_users(lists, heads, {"is_business_account": True}, 5))
    assert "PartitionFilters: [isnotnull(band" in text and "lists" in text
    assert "followers" not in text


def test_no_posts(spark, clean, tmp_path):
    userlists.save_lists(clean.limit(0), str(tmp_path))
    assert userlists.top_users(*userlists.load_lists(spark, str(tmp_path)), {}).collect() == []
