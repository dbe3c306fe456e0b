from __future__ import annotations

import re
from collections import Counter, defaultdict
from itertools import islice

import numpy as np
import pytest

from postgrain.llm import divergence
from postgrain.llm.queries import ORACLE_SQL, QUERIES
from tests.compare import difference, oracle_connection
from tests.llm.data import documents, odd_rows, with_clashes

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_force(rows, least, top=50):
    """rows: (doc_id, text, lang, source)"""
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source in rows:
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        groups.add((lang or "", source or ""))
        counts[lang or "", source or ""].update(found)
        docs[lang or ""].update(set(found))
    out = []
    for lang, source in groups:
        kept = [t for t, n in docs[lang].items() if n >= least]
        peers = [s for at, s in groups if at == lang]
        whole = Counter()
        for s in peers:
            whole.update(counts[lang, s])

        def share(count, t, kept=kept):
            return 1 + 10**9 * (count[t] + 5) // (sum(count[x] for x in kept) + 5 * len(kept))

        own = {t: share(counts[lang, source], t) for t in kept}
        pairs = [(sum(abs(own[t] - share(counts[lang, s], t)) for t in kept), s) for s in peers if s != source]
        terms = [(own[t] - share(whole, t), t) for t in kept if counts[lang, source][t] and own[t] > share(whole, t)]
        for part, found, most in (("pair", pairs, None), ("term", terms, top)):
            ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))
            out += [(lang, source, part, item, value, rank) for rank, (value, item) in islice(enumerate(ranked, 1), most)]
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def corpus():
    rng = np.random.default_rng(5)
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(120)] + ["Été", "日本", "x1y", "A"]
    rows = []
    for i in range(400):
        source = "hot" if i % 3 == 0 else f"s{i % 5}"
        take = rng.zipf(1.4, 30) % len(words) if source != "s2" else rng.integers(60, len(words), 30)
        rows.append((i, " ".join(words[t] for t in take), ["en", "fr", None][i % 4 % 3], source))
    return rows


@pytest.mark.parametrize("slice_postings", [1 << 17, 40])
def test_equals_brute_force(spark, slice_postings):
    rows = corpus() + [(900, None, "en", "empty"), (901, "", "de", "alone"), (902, "rare words", "de", "other")]
    got = rows_of(divergence.audit(documents(spark, rows), least_documents=10, slice_postings=slice_postings))
    assert got == brute_force(rows, 10)
    assert {r[3]: r[4] for r in got if r[0] == "de" and r[2] == "pair"} == {"alone": 0, "other": 0}


def test_odd_rows(spark):
    rows = odd_rows()
    df = with_clashes(documents(spark, rows), "term", "n", "docs", "total", "slice", "value", "rank", "item", "part")
    assert rows_of(divergence.audit(df, least_documents=2, top_terms=3)) == brute_force(rows, 2, 3)
    assert rows_of(divergence.audit(df.limit(0))) == []


def test_counts_are_passed_on_in_parts(spark, monkeypatch):
    monkeypatch.setattr(divergence, "FLUSH", 10)
    monkeypatch.setattr(divergence, "PIECE_BYTES", 7)
    rows = corpus()[:60]
    found = divergence.terms_of("Ab cd ab éa-".encode() * 5)
    assert found == Counter({b"ab": 10, b"cd": 5, "éa".encode(): 5})
    got = divergence.count_terms(documents(spark, rows)).where("term is not null").groupBy("term").sum("n").collect()
    assert {r[0]: r[1] for r in got} == Counter(t for r in rows for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", r[1].translate(LOWER)))


def test_shares_are_exact_beyond_the_digits_of_a_double():
    counts, total = np.array([0, 7, 10**14 + 3]), np.array([10**14 + 10] * 3)
    want = [1 + 10**9 * (int(c) + 5) // (10**14 + 10 + 5 * 9) for c in counts]
    assert divergence.shares(counts, total, 9).tolist() == want


def test_query_equals_sql(spark):
    sf_dir = "/root/testdata/sf0.01"
    assert difference(spark, oracle_connection(sf_dir), QUERIES["op12_source_divergence"], ORACLE_SQL["op12_source_divergence"], sf_dir) == ""
