from __future__ import annotations

import collections
import re

import pytest

from postgrain.llm.mixing import mix, mixed_documents
from postgrain.llm.queries import QUERIES
from tests.llm.data import documents, odd_rows, with_clashes


def slow_targets(size_of):
    """Share, stop at three times the size, share the excess again, until none is above."""
    order = sorted(size_of, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    target, free, left = {}, set(order), float(sum(size_of.values()))
    while free:
        share = left / sum(weight[s] for s in free)
        over = {s for s in free if share * weight[s] > 3 * size_of[s]}
        if not over:
            return target | {s: share * weight[s] for s in free}
        for s in over:
            target[s] = 3.0 * size_of[s]
            left -= target[s]
        free -= over
    return target


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def check(rows, got):
    assert collections.Counter((r[0], words(r[1]), r[3]) for r in rows) == collections.Counter((g["key"], g["size"], g["source"]) for g in got)
    size_of, taken, largest = collections.Counter(), collections.Counter(), collections.Counter()
    for r in rows:
        size_of[r[3]] += words(r[1])
    for g in got:
        taken[g["source"]] += g["taken"]
        largest[g["source"]] = max(largest[g["source"]], g["size"])
        assert 0 <= g["taken"] <= 3 * g["size"] and g["taken"] % max(1, g["size"]) == 0
    targets = slow_targets({s: size_of[s] for s in {r[3] for r in rows}})
    for g in got:
        assert g["source_size"] == size_of[g["source"]]
        assert g["target"] == pytest.approx(targets[g["source"]])
    for s, t in targets.items():
        assert abs(taken[s] - t) <= largest[s] + 1e-6


def test_odd_rows(spark):
    rows = odd_rows()
    df = with_clashes(documents(spark, rows), "size", "target", "u", "rows", "copies", "key")
    got = [r.asDict() | {"key": r["doc_id"]} for r in mix(df, block=2).collect()]
    check(rows, got)
    assert sorted(map(str, got)) == sorted(str(r.asDict() | {"key": r["doc_id"]}) for r in mix(df.repartition(5), block=2).collect())


def test_a_hot_source_and_a_tree_of_levels(spark):
    rows = [(i, "w " * (i % 37 + 1), "en", "hot" if i % 3 else f"s{i % 7}") for i in range(3000)]
    got = [r.asDict() | {"key": r["doc_id"]} for r in mix(documents(spark, rows), block=8).collect()]
    check(rows, got)


def test_one_row_fills_a_source(spark, tmp_path):
    rows = [(7, "some more words of a short text", "en", "one")] * 1000 + [(i, "w " * (1 + i % 9), "en", "other") for i in range(2000)]
    df = documents(spark, rows)
    got = [r.asDict() | {"key": r["doc_id"]} for r in mix(df, block=8).collect()]
    check(rows, got)
    assert len({g["copies"] for g in got if g["source"] == "one"}) == 2
    df.repartition(7).write.parquet(str(tmp_path / "d"))
    plan = collections.Counter()
    for g in got:
        plan[g["doc_id"], g["size"], g["source"]] += g["copies"]
    mixed = mixed_documents(spark.read.parquet(str(tmp_path / "d")), block=8)
    assert collections.Counter((r["doc_id"], words(r["text"]), r["source"]) for r in mixed.collect()) == +plan


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    check(rows, [r.asDict() | {"key": r["doc_id"]} for r in QUERIES["op3_pivotal_mix"](spark, sf).collect()])


def test_documents_repeat_as_planned(spark):
    df = documents(spark, odd_rows())
    plan = collections.Counter()
    for r in mix(df).collect():
        plan[r["doc_id"], r["size"], r["source"]] += r["copies"]
    got = mixed_documents(with_clashes(df, "copies", "size"))
    assert got.columns[:5] == df.columns
    assert collections.Counter((r["doc_id"], words(r["text"]), r["source"]) for r in got.collect()) == +plan


def test_no_documents(spark):
    df = documents(spark, odd_rows()).limit(0)
    assert mix(df).count() == 0
    assert mixed_documents(df).count() == 0
