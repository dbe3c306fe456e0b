from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from postgrain.llm.neighbours import nearest
from postgrain.llm.queries import QUERIES
from tests.llm.data import with_clashes

SCHEMA = "vec_id long, embedding array<float>, label int"


def slow(rows, ask, k):
    """Exact neighbours of distinct (id, vector) rows with usable vectors."""
    fine = {}
    for i, v in rows:
        if v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            fine[i, tuple(v)] = np.array(v, np.float64) / np.linalg.norm(np.array(v, np.float64))
    out = {}
    for (i, v), a in fine.items():
        if ask(i):
            near = sorted((-(1.0 if v == w else float(a @ b)), j) for (j, w), b in fine.items() if j != i)[:k]
            out[i] = [(j, -s) for s, j in near]
    return out


def by_query(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_odd_vectors(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [2.0, 0.1]), (4, None), (5, []), (6, [0.0, 0.0]), (7, [1.0, None]),
            (8, [nan, 1.0]), (9, [inf, 1.0]), (10, [-1.0, 0.0]), (11, [1e-30, 1e-30]), (11, [1e-30, 1e-30]), (12, [1.0, 2.0, 3.0]), (13, [1e30, -2e30])]
    df = with_clashes(spark.createDataFrame([(*r, None) for r in rows], SCHEMA), "id", "vec", "unit", "rank")
    got = by_query(nearest(df, F.col("id") % 2 == 0, k=3).collect())
    stored = [(i, v and [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    want = slow([r for r in stored if r[0] != 12], lambda i: i % 2 == 0, 3)
    assert {i: [x[0] for x in v] for i, v in got.items()} == {i: [x[0] for x in v] for i, v in want.items()}
    for i, v in got.items():
        assert [x[1] for x in v] == pytest.approx([x[1] for x in want[i]], abs=1e-12)


def test_few_or_no_candidates(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0], 1), (50, [2.0, 1.0], 1)], SCHEMA)
    assert {(r["query_id"], r["vec_id"]) for r in nearest(df, F.col("id") >= 0).collect()} == {(0, 50), (50, 0)}
    assert nearest(df.limit(1), F.col("id") >= 0).count() == 0
    assert nearest(df.limit(0), F.col("id") >= 0).count() == 0


def test_one_vector_fills_a_third(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [0.5, 0.5, 0.1] if i % 3 == 0 else rng.standard_normal(3).tolist()) for i in range(300)]
    df = spark.createDataFrame([(*r, None) for r in rows], SCHEMA)
    got = by_query(nearest(df, F.col("id") % 10 == 0).collect())
    want = slow([(i, np.array(v, np.float32).tolist()) for i, v in rows], lambda i: i % 10 == 0, 5)
    for i in range(0, 300, 30):
        assert [x[0] for x in got[i]] == [j for j in range(0, 30, 3) if j != i][:5]
    hits = sum(len({x[0] for x in got[i]} & {x[0] for x in want[i]}) for i in want)
    assert hits >= 0.95 * 5 * len(want)


@pytest.mark.parametrize("noise", [0.02, 0.002])
def test_recall_in_a_cluster_of_near_equal_vectors(spark, noise):
    rng = np.random.default_rng(7)
    centre = rng.standard_normal(64)
    vectors = (centre * (1 + noise * rng.standard_normal((2000, 64)))).astype(np.float32)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    got = by_query(nearest(spark.createDataFrame([(*r, None) for r in rows], SCHEMA), F.col("id") % 50 == 0).collect())
    want = slow(rows, lambda i: i % 50 == 0, 5)
    assert sum(len({x[0] for x in got[i]} & {x[0] for x in want[i]}) for i in want) >= 0.9 * 5 * len(want)


def test_recall_on_the_table(spark):
    sf = "/root/testdata/sf0.1"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = slow(rows, lambda i: i % 50 == 0, 5)
    got = by_query(QUERIES["op4_graph_neighbours"](spark, sf).collect())
    assert set(got) == set(want) and all(len(v) == 5 for v in got.values())
    assert sum(len({x[0] for x in got[i]} & {x[0] for x in want[i]}) for i in want) >= 0.95 * 5 * len(want)
    exact = {(i, j): s for i, v in slow(rows, lambda i: i % 50 == 0, len(rows)).items() for j, s in v}
    for i, v in got.items():
        for j, s in v:
            assert s == pytest.approx(exact[i, j], abs=1e-12)
