from __future__ import annotations

import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from postgrain.llm import spelling
from postgrain.llm.queries import QUERIES
from tests.llm.data import documents, odd_rows, with_clashes

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(rows, planted, least=3):
    counts = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if planted and h % planted == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= least}


def neighbours(words):
    """By deletion: words that become one string without one of their code points, looked at code point by code point."""
    by_cut = {}
    for w in words:
        for x in {w} | {w[:i] + w[i + 1 :] for i in range(len(w))}:
            by_cut.setdefault(x, set()).add(w)
    near = {w: set() for w in words}
    for group in by_cut.values():
        for u in group:
            for v in group:
                short, long = sorted((u, v), key=len)
                if len(u) == len(v):
                    ok = sum(a != b for a, b in zip(u, v, strict=True)) == 1
                else:
                    ok = len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))
                if ok:
                    near[u].add(v)
    return near


def brute_force(counts):
    near, out = neighbours(counts), []
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * n else None
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(out, key=str)


def rows_of(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def vocabulary(seed, alphabet, longest, size):
    rng = np.random.default_rng(seed)
    return sorted({"".join(rng.choice(list(alphabet), rng.integers(5, longest + 1))) for _ in range(size)})


@pytest.mark.parametrize(("lo", "top"), [(0, 3), (3, 7), (0, 7), (2, 3), (6, 7), (5, 6)])
def test_a_cell_equals_brute_force(lo, top):
    words = [w for w in vocabulary(lo, "abé", 7, 900) if len(w) in (6, 7)]
    cells = np.unique([w[:lo] + "|" + w[len(w) - max(0, 6 - top) :] if top < 6 else w[:lo] for w in words], return_inverse=True)[1]
    i, j = spelling.near_pairs(words, cells, 6, lo, top)
    got = sorted((words[a], words[b]) if words[a] < words[b] else (words[b], words[a]) for a, b in zip(i, j, strict=True))

    def place(u, v):
        return next((k for k in range(6) if u[k] != v[k]), 6)

    near = neighbours(words)
    want = sorted(
        (u, v) for u in words for v in near[u]
        if u < v and min(len(u), len(v)) == 6 and lo <= place(u, v) < top
    )
    assert got == want


@pytest.mark.parametrize("sizes", [{}, {"cell_words": 4, "task_words": 30}, {"cell_words": 1, "task_words": 1000}])
def test_equals_brute_force(spark, sizes):
    rng = np.random.default_rng(3)
    words = vocabulary(1, "abcü", 9, 700)
    often = rng.permutation(1 / np.arange(1, len(words) + 1))
    rows = [(i, " ".join(rng.choice(words, 90, p=often / often.sum())), "en", "a") for i in range(300)]
    got = rows_of(spelling.group_variants(documents(spark, rows), planted=97, **sizes))
    want = brute_force(counted(rows, 97))
    assert got == want and any(r[2] != r[1] and r[1] for r in got)


def test_odd_rows(spark):
    long = "q" * 3000
    rows = odd_rows() + [(20, f"{long}a {long}b {long} " * 3, "en", "a"), (None, "quicks " * 9, "en", None), (21, "ÀÈÌÒÙ àèìòù " * 4, "fr", "b")]
    rows += [(22, "aaaaa aaaaaa aaaaaaa aaaaaaaa " * 3, "en", "a")]
    df = with_clashes(documents(spark, rows), "word", "n", "cell", "near", "form", "root", "size", "shorter", "lo", "top")
    assert rows_of(spelling.group_variants(df)) == brute_force(counted(rows, 0))
    assert rows_of(spelling.group_variants(df, planted=1)) == brute_force(counted(rows, 1))
    assert rows_of(spelling.group_variants(df.limit(0))) == []


def test_counts_are_passed_on_in_parts(spark, monkeypatch):
    monkeypatch.setattr(spelling, "FLUSH", 5)
    monkeypatch.setattr(spelling, "PIECE", 9)
    rows = [(i, "Hello world, again and again: hello worlds", "en", "a") for i in range(40)]
    got = spelling.count_words(documents(spark, rows), 3).where("n >= 3").collect()
    assert {r[0]: r[1] for r in got} == counted(rows, 3)


def test_query_equals_brute_force(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert rows_of(QUERIES["op11_spelling_variants"](spark, sf_dir)) == brute_force(counted(rows, 97))
