from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from postgrain import functions as fx


def one(spark, expr, *values):
    """The expression over a one-row frame with columns a, b, ..."""
    names = "abcdef"[: len(values)]
    schema = ", ".join(f"{n} {t}" for n, (t, _) in zip(names, values))
    return spark.createDataFrame([tuple(v for _, v in values)], schema).select(expr).first()[0]


@pytest.mark.parametrize("raw, clean", [
    ("  Ann ", "ann"), ("\tAnn\r\n", "ann"), ("an n", "an n"), ("   ", ""), ("", ""), (None, None),
    ("ÉMILE", "émile"),
])
def test_normalize_username(spark, raw, clean):
    assert one(spark, fx.normalize_username(F.col("a")), ("string", raw)) == clean


@pytest.mark.parametrize("likes, comments, total", [
    (3.0, 4.0, 7.0), (None, 4.0, 4.0), (3.0, None, 3.0), (None, None, 0.0),
])
def test_engagement_counts_missing_as_zero(spark, likes, comments, total):
    expr = fx.engagement(F.col("a"), F.col("b"))
    assert one(spark, expr, ("double", likes), ("double", comments)) == total


@pytest.mark.parametrize("amount, followers, rate", [
    (5.0, 10.0, 0.5), (5.0, 0.0, None), (5.0, -3.0, None), (5.0, None, None), (None, 10.0, None),
])
def test_per_follower(spark, amount, followers, rate):
    expr = fx.per_follower(F.col("a"), F.col("b"))
    assert one(spark, expr, ("double", amount), ("double", followers)) == rate


@pytest.mark.parametrize("kind, label", [
    (1, "Post Type 1"), (2, "Post Type 2"), (3, "Post Type 2"), (None, "Post Type 2"),
])
def test_post_type_label(spark, kind, label):
    assert one(spark, fx.post_type_label(F.col("a")), ("int", kind)) == label


@pytest.mark.parametrize("flag, label", [(True, "Business"), (False, "Non-business"), (None, None)])
def test_account_label(spark, flag, label):
    assert one(spark, fx.account_label(F.col("a")), ("boolean", flag)) == label


@pytest.mark.parametrize("raw, clean", [
    (None, "Unknown"), ("", "Unknown"), ("  ", "Unknown"), (" Paris ", "Paris"),
])
def test_location(spark, raw, clean):
    assert one(spark, fx.location_or_unknown(F.col("a")), ("string", raw)) == clean


@pytest.mark.parametrize("text, parsed", [
    ("2019-03-04 05:06:07", dt.datetime(2019, 3, 4, 5, 6, 7)),
    ("not-a-date", None), ("2019-13-04 05:06:07", None), ("", None), (None, None),
])
def test_parse_post_timestamp(spark, text, parsed):
    assert one(spark, fx.parse_post_timestamp(F.col("a")), ("string", text)) == parsed


@pytest.mark.parametrize("text", [
    "2019-03-04T05:06:07.000Z", "2019-03-04 05:06:07 UTC", "2019-03-04 05:06:07",
])
def test_parse_legacy_timestamp_accepts_three_forms(spark, text):
    got = one(spark, fx.parse_legacy_timestamp(F.col("a")), ("string", text))
    assert got == dt.datetime(2019, 3, 4, 5, 6, 7)


def test_parse_legacy_timestamp_of_junk_is_null(spark):
    assert one(spark, fx.parse_legacy_timestamp(F.col("a")), ("string", "soon")) is None


def test_weekday_starts_on_sunday(spark):
    parts = fx.date_parts(fx.parse_post_timestamp(F.col("a")))
    sunday = ("string", "2019-03-03 23:00:00")
    assert one(spark, parts["day_of_week"], sunday) == 1
    assert one(spark, parts["post_hour"], sunday) == 23


def python_hash(text: str, seed: int, factor: int) -> int:
    h = seed
    for ch in text:
        h = (h * factor + ord(ch)) % 2147483647
    return h


@pytest.mark.parametrize("name, h1, h2", [
    ("darude", 2017377119, 1464320383), ("é😀x", 197871750, 1765255351), ("", 5381, 1),
])
def test_hash_vectors(spark, name, h1, h2):
    points = fx.code_points(F.col("a"))
    assert one(spark, fx.djb2(points), ("string", name)) == h1
    assert one(spark, fx.sdbm(points), ("string", name)) == h2


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=30), min_size=1, max_size=40))
def test_hashes_equal_a_plain_loop(spark, names):
    points = fx.code_points(F.col("a"))
    df = spark.createDataFrame([(n,) for n in names], "a string")
    for n, h1, h2 in df.select("a", fx.djb2(points), fx.sdbm(points)).collect():
        assert h1 == python_hash(n, 5381, 33)
        assert h2 == max(1, python_hash(n, 0, 65599))
