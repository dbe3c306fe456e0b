from __future__ import annotations

import pytest
from pyspark.sql.classic.dataframe import DataFrame

from postgrain.operators import blocked_bloom, bloom, cleaning, slices
from postgrain.plans import refresh
from postgrain.plans.queries import comparable
from tests.data import post, posts


def batches():
    first = [post(i, f"u{i % 7}", date=f"20{10 + i % 4}-03-04 05:06:07", likes=i) for i in range(40)]
    first += [post(100, "mover", date="2019-01-01 00:00:00"), post(101, "stays", date="2011-01-01 00:00:00"), post(None, "idless", date="2010-06-06 06:06:06"), post(102, "undated", date="soon")]
    first += [post(103, "alone", date="2005-05-05 05:05:05")]
    second = [post(100, "mover", date="2012-01-01 00:00:00"), post(101, "later", date="2013-01-01 00:00:00"), post(102, "undated", date="2010-02-02 02:02:02")]
    second += [post(103, "alone", date="2004-05-05 05:05:05"), post(None, "idless", date="2010-06-06 06:06:06"), post(3, "   "), post(200, "new", date="2012-07-07 07:07:07"), post(3, "u3", date="2013-03-04 05:06:07", likes=3)]
    third = [post(200, "new", date="2012-07-07 07:07:07"), post(300, "x" * 9, date="2020-01-01 00:00:00")]
    return [first, second, third]


def rows_of(df):
    return sorted(map(str, (tuple(r) for r in comparable(df.select(*sorted(df.columns))).collect())))


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("store"))
    for number, rows in enumerate(batches(), 1):
        assert refresh.apply_batch(spark, path, posts(spark, rows)) == number
    return path


def test_batches_equal_one_full_run(spark, store):
    raw = posts(spark, [r for rows in batches() for r in rows])
    clean = cleaning.clean_posts(raw, dedup=True)
    assert rows_of(refresh.clean_posts(spark, store)) == rows_of(clean)
    assert rows_of(refresh.filter_cube(spark, store)) == rows_of(slices.filter_cube(clean))
    for selection in ({}, {"is_business_account": False}):
        assert refresh.top_users(spark, store, selection).collect() == slices.slice_top_users(clean, selection).collect()


def test_bloom_words_equal_one_full_run(spark, store):
    users, sizes, words = refresh.load_bloom(spark, store)
    raw = posts(spark, [r for rows in batches() for r in rows])
    want = bloom.distinct_users(raw)
    assert rows_of(users) == rows_of(want)
    assert rows_of(words) == rows_of(blocked_bloom.build(want, sizes))
    assert sizes.first()["users"] == want.count()


def test_only_touched_years_are_written(spark, store):
    _, held = refresh.manifest(spark, store)
    # 2019 and 2005 lost their only posts; 2011 holds an id of the second batch; nothing touched it later.
    assert 2019 not in held and 2005 not in held and held[2011] == 2 and held[2004] == 2 and held[2012] == 3 and held[2020] == 3


def test_a_batch_that_failed_is_run_again(spark, store, tmp_path, monkeypatch):
    path = str(tmp_path)
    first, second, _ = batches()
    refresh.apply_batch(spark, path, posts(spark, first))
    before = rows_of(refresh.clean_posts(spark, path))
    with monkeypatch.context() as m:
        m.setattr(refresh, "_grow_bloom", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            refresh.apply_batch(spark, path, posts(spark, second))
    assert rows_of(refresh.clean_posts(spark, path)) == before
    assert refresh.apply_batch(spark, path, posts(spark, second)) == 2
    raw = posts(spark, first + second)
    assert rows_of(refresh.clean_posts(spark, path)) == rows_of(cleaning.clean_posts(raw, dedup=True))


def test_the_filter_grows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(refresh, "LEAST_CAPACITY", 4)
    rows = [[post(i, f"u{i}") for i in range(a, b)] for a, b in ((0, 3), (3, 4), (4, 40))]
    for part in rows:
        refresh.apply_batch(spark, str(tmp_path), posts(spark, part))
    users, sizes, words = refresh.load_bloom(spark, str(tmp_path))
    assert sizes.first()["capacity"] == 64 and users.count() == 40
    assert rows_of(words) == rows_of(blocked_bloom.build(users, sizes))


def test_tables_are_written_from_the_shuffle_they_come_out_of(spark, tmp_path, monkeypatch):
    """Neither posts nor totals are shuffled again to be written by year, and every year's rows are in its folder."""
    hints, plain = [], DataFrame.hint
    monkeypatch.setattr(DataFrame, "hint", lambda df, name, *args: hints.append(name) or plain(df, name, *args))
    for rows in batches()[:2]:
        refresh.apply_batch(spark, str(tmp_path), posts(spark, rows))
    assert hints == []
    _, held = refresh.manifest(spark, str(tmp_path))
    folders = {int(p.name.split("=")[1]) for p in (tmp_path / "posts" / "generation=2").glob("year=*")}
    assert folders == {y for y, g in held.items() if g == 2}


def test_an_empty_batch(spark, tmp_path):
    refresh.apply_batch(spark, str(tmp_path), posts(spark, []))
    assert refresh.clean_posts(spark, str(tmp_path)).collect() == []
    refresh.apply_batch(spark, str(tmp_path), posts(spark, [post(1)]))
    assert refresh.clean_posts(spark, str(tmp_path)).count() == 1
