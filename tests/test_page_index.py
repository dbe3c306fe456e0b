from __future__ import annotations

import pytest

from postgrain.operators import cleaning, explorer, page_index
from tests.data import post, posts
from tests.test_plans import plan
from tests.test_userlists import corpus


@pytest.fixture(scope="module")
def clean(spark, tmp_path_factory):
    rows = corpus(seed=6, n=1100) + [post(5000 + i % 3, "twin") for i in range(500)] + [post(None, "nobody")]
    path = str(tmp_path_factory.mktemp("clean"))
    cleaning.clean_posts(posts(spark, rows)).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def stored(spark, clean, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("pages"))
    page_index.save_pages(clean, path, range_rows=60)
    pages, index = page_index.load_pages(spark, path)
    page_index.save_search(pages, path)
    return pages, index, page_index.load_search(spark, path)


def test_ranges_are_even(stored):
    sizes = [r[0] for r in stored[1].groupBy("range").sum("posts").select("sum(posts)").collect()]
    assert len(sizes) > 15 and max(sizes) < 200


@pytest.mark.parametrize("selection", [{}, {"is_business_account": True}, {"description_category": "art", "post_type_label": "Post Type 2"}])
def test_every_page_equals_the_offset_form(clean, stored, selection):
    pages, index, _ = stored
    for page in (0, 1, 7, 16, 40, 400):
        got = page_index.seek_page(pages, index, selection, page, 23).collect()
        assert got == explorer.explorer_page(clean, selection, page=page, size=23).collect()


def test_a_deep_page_reads_its_range(stored):
    pages, index, _ = stored
    low, high, before = page_index.page_place(index, {}, 1500, 10).first()
    assert high - low <= 1 and before <= 1500
    text = plan(page_index.seek_page(pages, index, {}, 150, 10))
    assert f"(range#" in text and f">= {low}" in text and "PartitionFilters: [isnotnull(range" in text
    assert pages.filter(pages["range"].between(low, high)).count() < 300


@pytest.mark.parametrize("terms", [
    {"username": "u1"}, {"username": "U12"}, {"username": "twin", "date": "2019-03"}, {"likes": "11.0"}, {"description_category": "nothing at all"},
    {"username": ""}, {"is_business_account": "tru"},
])
def test_search_equals_the_scan(clean, stored, terms):
    pages, _, search = stored
    for selection in ({}, {"is_business_account": True}):
        got = page_index.search_pages(pages, search, selection, terms, 0, 40).collect()
        assert got == explorer.explorer_page(clean, selection, terms, page=0, size=40).collect()


def test_a_search_reads_the_ranges_that_hold_the_term(stored):
    pages, _, search = stored
    found = page_index.values_with(*search, "username", "nobod")
    held = search[0].filter("column = 'username'").join(found, "value", "left_semi").select("range").distinct()
    assert pages.join(held, "range", "left_semi").count() < pages.count() / 5
    assert "dynamicpruning" in plan(page_index.search_pages(pages, search, {}, {"username": "nobod"}))


def test_no_posts(spark, clean, tmp_path):
    page_index.save_pages(clean.limit(0), str(tmp_path))
    pages, index = page_index.load_pages(spark, str(tmp_path))
    page_index.save_search(pages, str(tmp_path))
    assert page_index.seek_page(pages, index, {}, 3, 10).collect() == []
    assert page_index.search_pages(pages, page_index.load_search(spark, str(tmp_path)), {}, {"username": "abc"}).collect() == []


def test_postings_grow_with_blocks_not_with_values(spark, tmp_path):
    """4,000 dates have 17 trigrams each; the blocks that hold them share most of these."""
    rows = [post(i, f"u{i % 9}", date=f"20{10 + i % 10}-0{1 + i % 9}-1{i % 7} 0{i % 8}:{i // 67:02d}:{i % 59:02d}") for i in range(4000)]
    page_index.save_pages(cleaning.clean_posts(posts(spark, rows)), str(tmp_path), range_rows=500)
    pages, _ = page_index.load_pages(spark, str(tmp_path))
    page_index.save_search(pages, str(tmp_path), ["date"])
    values, postings = page_index.load_search(spark, str(tmp_path))
    assert values.count() == 4000 and postings.count() < 4 * 4000
    got = page_index.values_with(values, postings, "date", "3-12 0")
    assert sorted(r[0] for r in got.collect()) == sorted({r["date"] for r in pages.select("date").collect() if "3-12 0" in r["date"]})


def test_a_search_does_not_shuffle_posts_by_value(stored):
    pages, _, search = stored
    text = plan(page_index.search_pages(pages, search, {}, {"username": "u12", "date": "2019"}))
    assert "hashpartitioning(value" not in text and "SortMergeJoin" not in text
