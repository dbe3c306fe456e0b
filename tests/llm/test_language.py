from __future__ import annotations

import zlib

from pyspark.sql import functions as F

from postgrain.llm.language import UNKNOWN, identify, learn_dictionaries
from postgrain.llm.queries import QUERIES
from tests.llm.data import documents, odd_rows, with_clashes

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op9_compression_language"](spark, SF).collect()
    assert len(got) == len(truth)
    held = [r for r in got if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.98 * len(held)
    assert sum(r["rejected"] for r in got) <= 0.01 * len(got)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_odd_rows(spark):
    df = with_clashes(documents(spark, odd_rows()), "language", "score", "rejected")
    learned = learn_dictionaries(df, F.lit(True))
    assert [lang for lang, _ in learned][0] == "en" and {lang for lang, _ in learned} == {"en", "de", "fr"}
    got = identify(df, learned).select("doc_id", "text", "language.*").collect()
    assert len(got) == len(odd_rows())
    for r in got:
        letters = any(map(str.isalpha, r["text"] or ""))
        assert (r["lang_pred"] == UNKNOWN) == (not letters)
        assert letters or (r["rejected"] and r["score"] == 0)


def test_nothing_learned_and_no_rows(spark):
    df = documents(spark, odd_rows())
    assert learn_dictionaries(df, F.lit(False)) == []
    assert {r["language"]["lang_pred"] for r in identify(df, []).collect()} == {UNKNOWN}
    assert identify(df.limit(0), learn_dictionaries(df, F.lit(True))).count() == 0
