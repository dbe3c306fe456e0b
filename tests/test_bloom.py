from __future__ import annotations

import math

import pytest

from postgrain.operators import bloom
from postgrain.sources import sinks
from tests.test_functions import python_hash

NAMES = [f"user_{i * i:06d}" for i in range(700)] + ["é😀x", "darude", "a" * 40]


@pytest.fixture(scope="module")
def users(spark):
    stored = [(n,) for n in NAMES] + [(f"  {n.upper()}\t",) for n in NAMES[:50]]
    stored += [(None,), ("",), (" \n",)] + [("darude",)] * 400
    return bloom.distinct_users(spark.createDataFrame(stored, "username string").repartition(5))


@pytest.fixture(scope="module")
def tables(users):
    params = bloom.bloom_params(users)
    return params, bloom.bloom_words(users, params)


def python_positions(name, m, k):
    h1, h2 = python_hash(name, 5381, 33), max(1, python_hash(name, 0, 65599))
    return {(h1 + i * h2) % m for i in range(k)}


def test_distinct_users_are_normalised(users):
    assert sorted(r["username"] for r in users.collect()) == sorted(NAMES)


def test_sizing(spark):
    names = spark.range(485_125).selectExpr("CAST(id AS string) AS username")
    got = bloom.bloom_params(names).first()
    assert (got["n"], got["m"], got["k"]) == (485_125, 4_649_952, 7)
    assert got["theoretical_fpr"] == pytest.approx(0.010039, abs=1e-6)


@pytest.mark.parametrize("n, m", [(0, 128), (1, 128), (13, 128), (14, 135)])
def test_sizing_of_small_sets(spark, n, m):
    got = bloom.bloom_params(spark.range(n).selectExpr("CAST(id AS string) AS username")).first()
    assert (got["n"], got["m"]) == (n, m)
    assert 2 <= got["k"] <= 20


def test_bits_equal_a_plain_model(tables):
    params, words = tables
    p = params.first()
    want = set().union(*(python_positions(n, p["m"], p["k"]) for n in NAMES))
    got = {
        r["word"] * 64 + bit for r in words.collect() for bit in range(64) if r["bits"] >> bit & 1
    }
    assert got == want


def test_no_user_is_missed(users, tables):
    params, words = tables
    verdicts = bloom.bloom_membership(users, words, params)
    assert verdicts.filter("bloom_verdict <> 'POSSIBLY PRESENT'").count() == 0
    assert verdicts.count() == len(NAMES)


def test_lookup_equals_a_plain_model(spark, users, tables):
    params, words = tables
    p = params.first()
    bits = set().union(*(python_positions(n, p["m"], p["k"]) for n in NAMES))
    strangers = [f"stranger-{i}" for i in range(3000)]
    raw = [(s,) for s in strangers + NAMES[:20]] + [("Darude ",)] * 500
    probes = bloom.distinct_probes(spark.createDataFrame(raw, "probe string"), "probe")
    got = {r["username"]: r["bloom_hit"] for r in bloom.bloom_lookup(probes, words, params).collect()}
    want = {
        n: python_positions(n, p["m"], p["k"]) <= bits for n in strangers + NAMES[:20] + ["darude"]
    }
    assert got == want
    # The two hashes are only loosely independent, hence a loose bound.
    rate = sum(got[s] for s in strangers) / len(strangers)
    assert rate < 3 * p["theoretical_fpr"]


def test_exact_membership(spark, users):
    probes = bloom.distinct_probes(
        spark.createDataFrame([("DARUDE",), ("nobody",), (None,)], "p string"), "p"
    )
    got = {r["username"]: r["exact_verdict"] for r in bloom.exact_membership(probes, users).collect()}
    assert got == {"darude": "PRESENT", "nobody": "ABSENT"}


def test_probe_set(users):
    rows = bloom.bloom_probe_set(users).collect()
    groups = {}
    for r in rows:
        groups.setdefault(r["probe_group"], set()).add(r["username"])
    assert groups["positive"] == set(NAMES)
    assert groups["far_negative"] == {f"not_a_real_user_{i}" for i in range(1, 501)}
    assert groups["near_miss"] and not groups["near_miss"] & set(NAMES)


def test_probe_set_drops_known_names(spark):
    names = [(f"not_a_real_user_{i}",) for i in range(1, 11)]
    rows = bloom.bloom_probe_set(spark.createDataFrame(names, "username string"))
    assert rows.filter("probe_group = 'far_negative'").count() == 490


def test_evaluation(users, tables):
    params, words = tables
    got = bloom.bloom_evaluation(params, words, bloom.bloom_probe_set(users), "here").first()
    assert got["data_source"] == "here"
    assert got["positive_queries"] == len(NAMES) and got["positive_false_negatives"] == 0
    assert got["negative_queries"] == 500
    assert got["false_positive_rate"] == got["false_positives"] / 500
    assert got["inserted_users"] == len(NAMES)
    assert got["bit_array_size"] == math.ceil(-len(NAMES) * math.log(0.01) / math.log(2) ** 2)


def test_wide_hashes_miss_no_user(spark, users):
    version = bloom.WIDE_HASH_VERSION
    params = bloom.bloom_params(users, version=version)
    words = bloom.bloom_words(users, params, version)
    got = bloom.bloom_evaluation(params, words, bloom.bloom_probe_set(users), "here", version).first()
    assert got["hash_version"] == version and got["positive_queries"] == len(NAMES)
    assert got["positive_false_negatives"] == 0 and got["false_positive_rate"] < 0.05
    hashed = bloom.hashes(users, version).agg({"h1": "max", "h2": "min"}).first()
    assert hashed[0] > 2**50 and hashed[1] >= 1


def test_empty_user_set(spark):
    users = spark.createDataFrame([], "username string")
    params = bloom.bloom_params(users)
    words = bloom.bloom_words(users, params)
    probes = spark.createDataFrame([("x",)], "username string")
    assert bloom.bloom_lookup(probes, words, params).first()["bloom_hit"] is False


def test_saved_tables_and_their_version(spark, users, tables, tmp_path):
    params, words = tables
    sinks.save_bloom(users, str(tmp_path), bloom.bloom_params, bloom.bloom_words)
    _, params2, words2 = sinks.load_bloom(spark, str(tmp_path), bloom.HASH_VERSION)
    assert params2.first() == params.first()
    assert words2.exceptAll(words).count() == 0
    with pytest.raises(ValueError, match="expected version other"):
        sinks.load_bloom(spark, str(tmp_path), "other")
