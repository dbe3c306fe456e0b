from __future__ import annotations

import hashlib
import math

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from postgrain.operators import blocked_bloom, bloom
from tests.test_plans import plan


def users(spark, n, prefix="user"):
    return spark.range(n).select(F.concat(F.lit(prefix), F.col("id").cast("string")).alias("username"))


@pytest.fixture(scope="module")
def tables(spark):
    known = users(spark, 20_000)
    sizes = blocked_bloom.params(known)
    return known, sizes, blocked_bloom.build(known, sizes)


def bits(name, blocks):
    digest = hashlib.md5(name.encode()).hexdigest()
    h1, h2 = int(digest[:15], 16), max(1, int(digest[15:30], 16))
    return h1 % blocks, [1 << (h2 >> 6 * lane & 63) for lane in range(8)]


def test_sizes(tables):
    n, blocks, m, k, target, rate, version = tables[1].first()
    assert (n, m, k, target, version) == (20_000, blocks * 512, 8, 0.01, "blocked-1")
    assert blocks == math.ceil(n / blocked_bloom.names_per_block(0.01)) and 9.5 < m / n < 11
    assert rate == pytest.approx(blocked_bloom.expected_rate(n / blocks)) and rate <= 0.01


def test_words_equal_plain_python(spark, tables):
    known, sizes, built = tables
    blocks = sizes.first()["blocks"]
    want = {}
    for (name,) in known.collect():
        block, lanes = bits(name, blocks)
        want[block] = [a | b for a, b in zip(want.get(block, [0] * 8), lanes, strict=True)]
    assert {r[0]: [w % 2**64 for w in r[1:]] for r in built.collect()} == want


def test_rates(spark, tables):
    known, sizes, built = tables
    assert blocked_bloom.lookup(known, built, sizes).filter("NOT bloom_hit").count() == 0
    false = blocked_bloom.lookup(users(spark, 20_000, "other"), built, sizes).filter("bloom_hit").count()
    assert 100 < false < 300


def test_a_probe_is_one_joined_row(spark, tables):
    _, sizes, built = tables
    text = plan(blocked_bloom.lookup(users(spark, 50, "user"), built, sizes))
    assert text.count("Generate") == 0 and text.count("Join") == 1


def test_no_users(spark):
    none = users(spark, 0)
    sizes = blocked_bloom.params(none)
    assert sizes.first()["blocks"] == 1 and sizes.first()["theoretical_fpr"] == 0
    built = blocked_bloom.build(none, sizes)
    assert not any(r["bloom_hit"] for r in blocked_bloom.lookup(users(spark, 9), built, sizes).collect())
    assert blocked_bloom.semi_join(users(spark, 9), none).count() == 0
    assert blocked_bloom.anti_join(users(spark, 9), none).count() == 9


def posts_of(spark):
    rows = [(i, f"user{i % 700}" if i % 9 else None) for i in range(5000)] + [(9000 + i, "user3") for i in range(2500)]
    return spark.createDataFrame(rows, "sid long, author string")


@pytest.mark.parametrize("most_blocks", [1 << 17, 1])
def test_joins_equal_the_exact_ones(spark, monkeypatch, most_blocks):
    monkeypatch.setattr(blocked_bloom, "SENT_BLOCKS", most_blocks)
    rows, wanted = posts_of(spark), users(spark, 200)
    exact = [rows.join(wanted.select(F.col("username").alias("author")), "author", how).select("sid", "author") for how in ("left_semi", "left_anti")]
    for got, want in zip((blocked_bloom.semi_join, blocked_bloom.anti_join), exact, strict=True):
        assert sorted(got(rows, wanted, "author").collect()) == sorted(want.collect())
    probes = rows.select(F.col("author").alias("username")).dropna().distinct()
    assert sorted(blocked_bloom.membership(probes, wanted).collect()) == sorted(bloom.exact_membership(probes, wanted).collect())


def test_only_hits_and_false_positives_reach_the_join(spark):
    rows, wanted = posts_of(spark), users(spark, 200)
    seen = Observation()
    passed = blocked_bloom._checked(rows, "author", wanted).filter("_hit").observe(seen, F.count(F.lit(1)).alias("n"))
    hits = passed.join(wanted.select(F.col("username").alias("author")), "author", "left_semi").count()
    assert hits <= seen.get["n"] <= hits * 1.05 < rows.count()
    text = plan(blocked_bloom.semi_join(rows, wanted, "author"))
    # The filter is applied before the rows are dealt out by name.
    assert text.index("LeftSemi") < text.index("LeftOuter")
