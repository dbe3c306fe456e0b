from __future__ import annotations

import collections
import hashlib
import random

import pytest

from postgrain.llm.queries import QUERIES
from postgrain.llm.repeats import spans_by_document
from tests.llm.data import documents, odd_rows, with_clashes


def slow(texts, length, keep_first=False):
    """(removed spans) of each text, from every window of every text."""
    raws = [(t or "").encode() for t in texts]
    at = collections.defaultdict(list)
    for d, raw in enumerate(raws):
        for i in range(len(raw) - length + 1):
            at[raw[i : i + length]].append((d, i))
    out = [bytearray(len(r)) for r in raws]
    for places in at.values():
        for d, i in places[1 if keep_first else 0 :] if len(places) > 1 else ():
            out[d][i : i + length] = b"\x01" * length
    found = []
    for raw, gone in zip(raws, out, strict=True):
        spans, i = [], 0
        while (a := gone.find(1, i)) >= 0:
            b = gone.find(0, a)
            i = b if b >= 0 else len(gone)
            spans.append((a, i))
        found.append((spans, hashlib.sha256(bytes(x for x, g in zip(raw, gone, strict=True) if not g)).hexdigest()))
    return found


def compare(rows, got, length, keep_first=False):
    want = collections.Counter(
        (r[0], len((r[1] or "").encode()), tuple(spans), sha) for r, (spans, sha) in zip(rows, slow([r[1] for r in rows], length, keep_first), strict=True)
    )
    have = collections.Counter((g["doc_id"], g["n_bytes"], tuple((s["start"], s["end"]) for s in g["spans"]), g["kept_sha256"]) for g in got)
    assert have == want
    for g in got:
        assert g["n_spans"] == len(g["spans"]) and g["n_removed"] == sum(s["end"] - s["start"] for s in g["spans"])


def corpus(seed):
    rng = random.Random(seed)
    piece = lambda n: "".join(rng.choice("abcd é") for _ in range(n))
    shared = [piece(n) for n in (30, 45, 60, 200)]
    texts = []
    for _ in range(40):
        text = piece(rng.randint(0, 60))
        for _ in range(rng.randint(0, 4)):
            s = rng.choice(shared)
            a = rng.randint(0, 10)
            text += s[a : len(s) - rng.randint(0, 10)] + piece(rng.randint(0, 30))
        texts.append(text)
    texts += [texts[3], texts[3], "ab" * 200, "z" * 150, "z" * 39, "", None]
    return [(i, t, "en", "s") for i, t in enumerate(texts)]


@pytest.mark.parametrize(("crowd", "per_block"), [(20_000, 1000), (1, 3), (3, 7)])
def test_same_as_every_window(spark, crowd, per_block):
    rows = corpus(crowd)
    df = documents(spark, rows).repartition(3)
    got = spans_by_document(df, min_bytes=40, gram=8, crowd=crowd, per_block=per_block).collect()
    compare(rows, got, 40)


@pytest.mark.parametrize(("crowd", "per_block"), [(20_000, 5), (1, 3), (3, 7)])
def test_the_first_copy_can_stay(spark, crowd, per_block):
    rows = corpus(5)
    df = documents(spark, rows).repartition(3)
    got = spans_by_document(df, min_bytes=40, gram=8, keep_first=True, crowd=crowd, per_block=per_block).collect()
    compare(rows, got, 40, keep_first=True)


@pytest.mark.parametrize("crowd", [20_000, 10])
def test_copies_of_a_text_go_but_for_the_first(spark, crowd):
    rng = random.Random(8)
    text, other = ("".join(rng.choice("abcdefgh ") for _ in range(n)) for n in (1500, 600))
    rows = [(i, text, "en", "s") for i in range(5)] + [(5, other + text, "en", "s"), (6, "short", "en", "s"), (7, "short", "en", "s")]
    rows += [(None, other, "en", "s"), (None, other, "en", "s"), (9, text[200:900], "en", "s"), (9, text[200:900], "en", "s")]
    got = spans_by_document(documents(spark, rows).repartition(3), keep_first=True, crowd=crowd, per_block=2, with_text=True).collect()
    order = sorted(rows, key=lambda r: (r[0] is None, r[0]))
    compare(order, got, 400, keep_first=True)
    left = sorted((g["doc_id"] is None, g["doc_id"], bytes(g["kept"])) for g in got if g["doc_id"] in (0, 1, 5, 6))
    assert left == [(False, 0, text.encode()), (False, 1, b""), (False, 5, other.encode()), (False, 6, b"short")]


def test_no_rows_and_no_texts_where_the_first_stays(spark):
    df = with_clashes(documents(spark, odd_rows()), "key", "n", "least", "copy", "run")
    compare(sorted(odd_rows(), key=lambda r: (r[0] is None, r[0])), spans_by_document(df, keep_first=True).collect(), 400, keep_first=True)
    assert spans_by_document(df.limit(0), keep_first=True).count() == 0


def test_odd_rows_and_what_is_left(spark):
    rows = [*odd_rows(), (11, "x" * 5000, "en", "a"), (12, "q" + "x" * 450, "en", "a")]
    df = with_clashes(documents(spark, rows), "key", "block", "kept", "spans")
    got = spans_by_document(df, with_text=True).collect()
    compare(rows, got, 400)
    left = {g["doc_id"]: bytes(g["kept"]) for g in got}
    assert left[11] == b"" and left[12] == b"q" and left[5] == b" \n\t"
    assert spans_by_document(df.limit(0)).count() == 0


def test_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = {(r[0], len(r[1].encode()), sum(e - s for s, e in spans), len(spans), sha) for r, (spans, sha) in zip(rows, slow([r[1] for r in rows], 400), strict=True)}
    got = QUERIES["op2_repeated_passages"](spark, sf).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(rows)
    assert sum(r["n_removed"] for r in got)
