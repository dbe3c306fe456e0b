from __future__ import annotations

import collections
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from postgrain.llm.lm import fit_weights, score_documents
from postgrain.llm.queries import QUERIES
from tests.llm.data import documents, odd_rows, with_clashes


def tokens(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]


def base(rows, learned):
    counts = collections.Counter(t for i, x in rows if learned(i) for t in tokens(x))
    n, v = counts.total(), len(counts)
    return n, lambda x: (len(tokens(x)), sum(t in counts for t in tokens(x)), sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens(x)))


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    n, score = base(rows.items(), lambda i: zlib.crc32(str(i).encode()) % 7 != 2)
    got = QUERIES["op1_deleted_interpolation"](spark, sf).collect()
    assert {r["doc_id"] for r in got} == set(rows) and len(got) == len(rows)
    gain = 0.0
    for r in got:
        want = score(rows[r["doc_id"]])
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (*want[:2], n)
        assert r["base_score"] == pytest.approx(want[2])
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2)
        gain += (r["score"] - r["base_score"]) * r["held_out"]
    assert gain > 0


def test_odd_rows_in_small_blocks(spark):
    rows = odd_rows()
    df = with_clashes(documents(spark, rows), "key", "fold", "block", "score")
    learn = F.col("doc_id") != 7
    n, score = base([r[:2] for r in rows], lambda i: i is not None and i != 7)
    for per_block in (1, 100):
        got = score_documents(df, learn, F.col("doc_id") == 1, per_block=per_block).collect()
        assert collections.Counter(r["doc_id"] for r in got) == collections.Counter(r[0] for r in rows)
        text = {r[0]: r[1] for r in rows}
        for r in got:
            want = score(text[r["doc_id"]])
            assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (*want[:2], n)
            assert r["base_score"] == pytest.approx(want[2])
            assert r["learned"] == (r["doc_id"] is not None and r["doc_id"] != 7)
            assert math.isfinite(r["score"]) and r["score"] <= 0


def test_the_model_knows_bigrams(spark):
    rows = [(i, "a b a b a b a c", "en", "s") for i in range(20)] + [(90, w, "en", "s") for w in ("a", "b", "c", "", "unseen")]
    got = {r["doc_id"]: r["score"] for r in score_documents(documents(spark, [*rows, (91, "a b", "en", "s"), (92, "a a", "en", "s")]), F.col("doc_id") < 20, F.col("doc_id") < 4).collect()}
    assert got[91] > got[92] + 1


def test_nothing_learned_and_no_rows(spark):
    df = documents(spark, odd_rows())
    got = score_documents(df, F.lit(False), F.lit(False)).collect()
    assert len(got) == len(odd_rows()) and all(r["train_tokens"] == r["n_known"] == r["base_score"] == 0 for r in got)
    assert score_documents(df.limit(0), F.lit(True), F.lit(False)).count() == 0


def test_expectation_maximisation_finds_the_mixture():
    strong, weak = np.array([5, 1 + 4 * 1, 1 + 4 * 10, 700]), np.array([5, 0, 1 + 4 * 3, 300])
    weights = fit_weights(np.array([strong, weak]), 1e-6)
    assert weights.shape[1] == 3 and np.allclose(weights.sum(axis=1), 1)
    assert 0.6 < weights[5][0] < 0.72
    assert np.allclose(weights[6], weights[5])
