from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from postgrain.llm.queries import QUERIES
from postgrain.llm.token_files import Encoder, from_bytes, to_bytes, token_index
from tests.llm.data import documents, odd_rows, with_clashes

PATH = public_tokenizers.path("byte_bpe_50k.json")
ENCODER = Encoder(PATH)
PLAIN = Tokenizer.from_file(PATH)


def plain(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab'sS1! \n\t\u00a0\u3000éß\u0085日‘\u2003", max_size=30) | st.text(max_size=20), max_size=4))
def test_pieces_give_the_ids_of_whole_texts(texts):
    ids, sizes = ENCODER.encode(pa.array(texts, pa.string()))
    assert [list(x) for x in np.split(ids, np.cumsum(sizes)[:-1])][: len(texts)] == [plain(t) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 40), max_size=1500))
def test_wavelet_matrix_answers(values):
    ids = np.array(values, np.uint16)
    _, _, m = from_bytes(to_bytes(ids, [1], np.array([len(values)]), 6))
    assert m.all().tolist() == values
    for i in range(0, len(values), 97):
        assert m.access(i) == values[i]
        assert m.count(values[i], i) == values[:i].count(values[i])
        assert m.locate(values[i], values[:i].count(values[i])) == i
    assert m.count(41) == 0


def check(rows, got):
    """rows: (doc_id, text), got: rows of the index"""
    want = sorted((d is not None, d or 0, len(plain(t)) + 1, zlib.crc32(np.array([*plain(t), 0], "<u4").tobytes())) for d, t in rows)
    assert want == sorted((g["doc_id"] is not None, g["doc_id"] or 0, g["n_tokens"], g["ids_crc32"]) for g in got)
    in_order = sorted(got, key=lambda g: (g["shard"], g["position"]))
    ids = [g["doc_id"] for g in in_order]
    assert ids == sorted(ids, key=lambda d: (d is not None, d or 0))
    start = 0
    for g in in_order:
        assert g["start"] == start
        start += g["n_tokens"]


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    check(rows, QUERIES["op8_wavelet_tokens"](spark, sf).collect())


def test_odd_rows(spark):
    df = with_clashes(documents(spark, odd_rows()), "start", "shard", "position", "content")
    check([(r[0], r[1]) for r in odd_rows()], token_index(df).collect())
    assert token_index(df.limit(0)).count() == 0


UNMODIFIED = Tokenizer.from_file(PATH)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["<|endoftext|>", "<|endof", "text|>", "end", "'s", "'", " ", "\n", "  ", "1", "!", "é", "日", "<|"]), max_size=9).map("".join), max_size=4))
def test_added_tokens_are_found_as_the_library_does(texts):
    texts = ["end <|endoftext|> start", "<|endof", "text|>", None, *texts]
    ids, sizes = ENCODER.encode(pa.array(texts, pa.string()))
    want = [UNMODIFIED.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert want[0] == [437, 220, 50256, 923]
    assert [list(x) for x in np.split(ids, np.cumsum(sizes)[:-1])] == want


def test_added_tokens_in_the_index(spark):
    text = "end <|endoftext|> start"
    ids = np.array([*UNMODIFIED.encode(text, add_special_tokens=False).ids, 0], "<u4")
    got = token_index(documents(spark, [(1, text, "en", "s"), (2, "x", "en", "s")])).orderBy("doc_id").collect()
    assert (got[0]["n_tokens"], got[0]["ids_crc32"], got[1]["start"]) == (5, zlib.crc32(ids.tobytes()), 5)
