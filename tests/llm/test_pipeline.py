from __future__ import annotations

import collections

import corpus_pipeline
from postgrain.llm.language import identify, learn_dictionaries
from postgrain.llm.queries import fold
from tests.llm import test_decontaminate, test_jaccard_join, test_mixing, test_token_files
from tests.llm.data import documents, odd_rows, with_clashes

SF = "/root/testdata/sf0.001"


def test_stages_one_after_the_other(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [tuple(r)[:2] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    plain = lambda df: [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in df.collect()]
    columns, rows = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES:
        before, rows = plain(rows), stage(spark, rows, SF)
        if name == "tokens":
            test_token_files.check([r[:2] for r in before], rows.collect())
            break
        assert rows.columns == columns
        rows = rows.cache()
        after = plain(rows)
        if name == "language":
            judged = identify(docs, learn_dictionaries(docs, fold(4) != 2)).collect()
            assert sorted(after) == sorted((r["doc_id"], r["text"], r["lang"], r["source"]) for r in judged if not r["language"]["rejected"])
            assert len(after) >= 0.98 * len(before)
        elif name == "near duplicates":
            components = test_jaccard_join.slow(before)
            assert sorted(r[0] for r in after) == sorted({k[2] for k in components})
        elif name == "benchmark":
            bad = {d for d, _, _ in test_decontaminate.slow([r[:2] for r in before], items)}
            assert bad and sorted(after) == sorted(r for r in before if r[0] not in bad)
        elif name == "mix":
            copies = collections.Counter(after)
            got = [{"key": r[0], "source": r[3], "size": test_mixing.words(r[1]), "taken": test_mixing.words(r[1]) * copies[r]} for r in before]
            size_of = collections.Counter()
            for g in got:
                size_of[g["source"]] += g["size"]
            targets = test_mixing.slow_targets(size_of)
            assert set(after) <= set(before) and max(copies.values()) <= 3
            for s, t in targets.items():
                own = [g for g in got if g["source"] == s]
                assert abs(sum(g["taken"] for g in own) - t) <= max(g["size"] for g in own) + 1e-6


def test_run_gives_the_last_stage(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32", "shard", "position"]
    assert got.count() > 50


def test_odd_and_no_documents(spark):
    for df in (documents(spark, odd_rows()), documents(spark, odd_rows()).limit(0)):
        rows = with_clashes(df, "key", "start", "language", "copies")
        for name, stage in corpus_pipeline.STAGES:
            columns, rows = rows.columns, stage(spark, rows, SF).cache()
            assert name == "tokens" or rows.columns == columns
            rows.count()
