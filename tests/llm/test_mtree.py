from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from postgrain.llm import mtree
from postgrain.llm.queries import ORACLE_SQL, QUERIES
from tests.compare import difference, oracle_connection
from tests.llm.data import with_clashes


def brute_force(rows, modulus, k=5):
    whole = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            whole[i, tuple(math.floor(256 * x) if abs(x) < 1e16 else int(math.copysign(2**63 - (x > 0), x)) for x in v)] = True
    out = []
    for q, a in whole:
        if q % modulus == 0:
            scores = sorted((-max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(a, b, strict=False)))), i) for i, b in whole if (i, b) != (q, a))
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


def got(df):
    assert df.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(tuple(r) for r in df.collect())


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


def clusters(n, dims=8, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dims))
    x = centres[rng.integers(0, 12, n)] + rng.normal(scale=0.05, size=(n, dims))
    return [(int(i), [float(c) for c in v]) for i, v in enumerate(np.round(x, 3))]


@pytest.mark.parametrize("sizes", [{}, {"part": 60, "pivots": 20, "nearest_cells": 2}, {"part": 40, "pivots": 1}])
def test_equals_brute_force(spark, sizes):
    rows = clusters(900)
    rows += [(2000 + i, rows[5][1]) for i in range(300)] + [(i, [5.0] * 8) for i in range(3000, 3008)]
    assert got(mtree.top_k(table(spark, rows), F.col("id") % 50 == 0, **sizes)) == brute_force(rows, 50)


def test_odd_vectors(spark):
    rows = [
        (0, [1.0, 2.0]), (0, [1.0, 2.0]), (0, [-1.0, 3.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0]), (5, [1.0, 2.0, 3.0]), (6, [1.0, None]),
        (7, [float("nan"), 1.0]), (8, [float("inf"), 1.0]), (9, [1e-9, -1e-9]), (None, [1.0, 1.0]), (10, [1e18, 2.0]), (11, [-1e18, 3.5]), (12, [3e12, 3e12]),
        (13, [3e12, 3e12 + 1 / 256]), (20, [1.0, 2.0]), (22, [1e300, 1.0]),
    ]
    df = with_clashes(table(spark, rows), "id", "cell", "part", "codes", "score", "rank", "node")
    df = df.withColumn("id", F.lit("clash"))
    assert got(mtree.top_k(df, F.col("id") % 2 == 0)) == brute_force(rows, 2)
    assert got(mtree.top_k(df.limit(0), F.col("id") % 2 == 0)) == []
    assert got(mtree.top_k(table(spark, rows[:1]), F.col("id") % 2 == 0)) == []


def test_stored_bounds_rule_distances_out():
    rows = np.floor(256 * np.array([v for _, v in clusters(3000)]))
    space = mtree.Space(8, float((rows**2).sum(axis=1).max()), rows[:1])
    x = space.lifted(rows)
    tree = mtree.build_tree(x, space.between(x, x[:1])[:, 0], space)
    assert np.bincount(tree["page"]).max() <= mtree.PAGE
    assert sorted(tree["row"][tree["child"] < 0].tolist()) == list(range(3000))
    for page, radius in zip(tree["child"], tree["radius"], strict=True):
        if page >= 0:
            assert tree["to_parent"][tree["page"] == page].max() <= radius
    import pyarrow as pa

    codes = pa.array(rows.astype(int).tolist())
    entries = pa.table({
        "page": tree["page"], "child": tree["child"], "radius": tree["radius"], "to_parent": tree["to_parent"],
        "codes": codes.take(pa.array(tree["row"])), "ids": pa.array([[int(r)] for r in tree["row"]]),
        "point": tree["row"],
    })
    searched = mtree.Tree(entries, space)
    for at in (3, 700, 2999):
        best, computed = searched.search(codes[at].as_py(), rows[at], float(space.reach(rows[at] @ rows[at], rows[at] @ rows[0])), None, 6)
        want = sorted((-int(s), i, i) for i, s in enumerate(rows @ rows[at]))[:6]
        assert best == want and computed < 1500


def test_query_equals_sql(spark):
    sf_dir = "/root/testdata/sf0.01"
    assert difference(spark, oracle_connection(sf_dir), QUERIES["op13_mtree_top_k"], ORACLE_SQL["op13_mtree_top_k"], sf_dir) == ""
