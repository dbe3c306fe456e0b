from __future__ import annotations

import collections
import random
import re

import pytest

from postgrain.llm.decontaminate import clean_documents, contaminated
from postgrain.llm.queries import QUERIES
from tests.llm.data import documents, odd_rows, with_clashes

ITEM = "item_id long, text string"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())


def bag(w, k):
    return collections.Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1))


def slow(docs, items):
    """(doc_id, text, item_id) -> best similarity over every window of the item's size."""
    out = {}
    for j, item in items:
        w = words(item)
        k = min(5, len(w))
        want = bag(w, k)
        for d, text in docs if w else ():
            t = words(text)
            best = 0.0
            for s in range(len(t) - len(w) + 1):
                got = bag(t[s : s + len(w)], k)
                if got.keys() & want.keys():
                    both = (got & want).total()
                    best = max(best, both / (got.total() + want.total() - both))
            if best >= 0.75:
                out[d, text, j] = best
    return out


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice(["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta", "theta", "iota", "kappa", "mu", "nu"]) + rng.choice("abcdefgh")
    items = [(j, " ".join(word() for _ in range(rng.choice([2, 4, 5, 6, 20, 40, 59])))) for j in range(12)]
    items += [(20, "a b a b a b a b a b a b a b a b"), (21, ""), (22, None), (3, items[3][1])]
    docs = []
    for d in range(60):
        text = [word() for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 2)):
            part = words(rng.choice(items)[1])
            for _ in range(rng.choice([0, 0, 1, 2, 6])):
                at = rng.randrange(len(part) or 1)
                part[at : at + 1] = rng.choice([[word()], [], [word(), word()]])
            text += [w.upper() if rng.random() < 0.3 else w for w in part] + [word() for _ in range(rng.randint(0, 10))]
        docs.append((d, rng.choice([" ", "\n", "\t "]).join(text)))
    return docs + [(100, "x y a b a b a b a b a b a b a b a b z"), (100, "x y a b a b a b a b a b a b a b a b z"), (101, None), (102, "")], items


@pytest.mark.parametrize("seed", [1, 2])
def test_same_as_every_window(spark, seed):
    docs, items = corpus(seed)
    df = with_clashes(documents(spark, [(*d, "en", "s") for d in docs]), "words", "item_id", "start", "hashes")
    bench = with_clashes(spark.createDataFrame(items, ITEM), "k", "words", "doc_id")
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in contaminated(df, bench).collect()}
    want = {(d, j): s for (d, _, j), s in slow(docs, items).items()}
    assert got == pytest.approx(want) and len(want) > 10


def test_clean_documents_stay(spark):
    docs, items = corpus(7)
    rows = [(*d, "en", "s") for d in docs]
    df, bench = documents(spark, rows), spark.createDataFrame(items, ITEM)
    bad = {(d, t) for d, t, _ in slow(docs, items)}
    got = clean_documents(df, bench)
    assert got.columns == df.columns
    assert collections.Counter((r["doc_id"], r["text"]) for r in got.collect()) == collections.Counter(d for d in docs if d not in bad)


def test_odd_rows_and_empty_tables(spark):
    df, bench = documents(spark, odd_rows()), spark.createDataFrame([(1, "brown fox jumps"), (None, "12 34 !! "), (2, " ")], ITEM)
    got = {(r["doc_id"], r["item_id"]) for r in contaminated(df, bench).collect()}
    assert got == {(1, 1), (2, 1), (None, 1), (9, 1), (8, None)}
    assert contaminated(df.limit(0), bench).count() == contaminated(df, bench.limit(0)).count() == 0
    assert clean_documents(df, bench.limit(0)).count() == len(odd_rows())


def test_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    load = lambda t: [tuple(r)[:2] for r in spark.read.parquet(f"{sf}/{t}.parquet").collect()]
    want = {(d, j): s for (d, _, j), s in slow(load("documents"), load("benchmark")).items()}
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in QUERIES["op7_benchmark_leaks"](spark, sf).collect()}
    assert got == pytest.approx(want) and got


def every_window(docs, items):
    """(doc_id, item_id) -> (best similarity, its first start, similar windows)."""
    out = {}
    for j, item in items:
        w = words(item)
        k = min(5, len(w))
        want = bag(w, k)
        for d, text in docs:
            t = words(text)
            shared = [(bag(t[s : s + len(w)], k) & want).total() for s in range(len(t) - len(w) + 1)]
            got = [x / (2 * want.total() - x) for x in shared]
            if got and max(got) >= 0.75:
                out[d, j] = (max(got), got.index(max(got)), sum(x >= 0.75 for x in got))
    return out


def test_window_between_two_alignments(spark):
    """The first and last 4 words changed and 8 inserted in the middle: the best window is lined up with no shared shingle."""
    item = [f"word{i}" for i in range(100)]
    edited = [f"new{i}" for i in range(4)] + item[4:50] + [f"more{i}" for i in range(8)] + item[50:96] + [f"last{i}" for i in range(4)]
    text = " ".join([f"before{i}" for i in range(200)] + edited + [f"after{i}" for i in range(50)])
    docs, items = [(1, text), (2, "nothing of it")], [(7, " ".join(item))]
    df, bench = documents(spark, [(*d, "en", "s") for d in docs]), spark.createDataFrame(items, ITEM)
    want = every_window(docs, items)
    assert want[1, 7][:2] == (pytest.approx(84 / 108), 204)
    got = {(r["doc_id"], r["item_id"]): (r["similarity"], r["start"], r["n_windows"]) for r in contaminated(df, bench, radius=63).collect()}
    assert got == want
    assert [r["doc_id"] for r in clean_documents(df, bench).collect()] == [2]
