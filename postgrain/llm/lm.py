"""Language-model scores by deleted interpolation.

A word's probability after the word before it mixes three estimates: the bigram's and the word's maximum likelihood, and one
over all types. The weights depend on how often the context was seen, in buckets of powers of two. They come from expectation-maximisation:
one fold of the learned documents is deleted from the counts, and the weights are fitted to what that fold then says of
its own words; the final counts are those of all learned documents.

Counting and scoring go by blocks (`blocks.py`), so a block asks once about each of its distinct words and bigrams.
For the fit, estimates are rounded to quarter octaves; the histogram of a fold of any size then stays below
`_STEPS` squared cells for each bucket, and the driver iterates on it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postgrain.llm.blocks import (
    DOCUMENTS_PER_BLOCK, QUESTION, answered, answers_of, block_count, from_ipc, pack, questions, table_of, totals,
)
from postgrain.llm.chat import _arrow
from postgrain.llm.store import stored
from postgrain.llm.text import SLICE_BYTES, _BASE, buffers, mixed, words

BEGIN, END = np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344)
WORDS, BIGRAMS = 1, 2
KEPT, LEARNED = 0, 1
_STEPS = 160
_BUCKETS = 48
ITERATIONS = 60


def _sequence(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes of the tokens, of the bigrams they end, where each row begins plus the end); an end token closes each row."""
    parts, firsts, done = [], [np.zeros(1, np.int64)], 0
    size = np.diff(buffers(texts)[1])
    edges = [0, *(np.flatnonzero(np.diff(np.cumsum(size) // SLICE_BYTES)) + 1).tolist(), len(texts)]
    for a, b in zip(edges, edges[1:], strict=False):
        word, first = words(*buffers(texts.slice(a, b - a)))
        parts.append(np.insert(word, first[1:], END))
        firsts.append(done + first[1:] + np.arange(1, len(first)))
        done += len(parts[-1])
    token, first = np.concatenate(parts) if parts else np.empty(0, np.uint64), np.concatenate(firsts)
    before = np.concatenate([[BEGIN], token[:-1]]).astype(np.uint64)
    before[first[:-1]] = BEGIN
    return token, mixed(before * _BASE + token), first


def _bucket(context: np.ndarray) -> np.ndarray:
    return np.where(context > 0, np.floor(np.log2(np.maximum(context, 1))).astype(np.int64) + 1, 0)


class _Block:
    """A block's texts with the answers to its questions."""

    def __init__(self, payloads: pa.Table):
        table = from_ipc(payloads["payload"]).combine_chunks()
        self.rows = table
        self.token, self.bigram, self.first = _sequence(table["text"].combine_chunks() if table.num_rows else pa.array([], pa.string()))
        fold = table["fold"].to_numpy()
        self.row = np.repeat(np.arange(len(fold)), np.diff(self.first))
        self.fold = fold
        self.words, self.word_at = np.unique(np.append(self.token, BEGIN), return_inverse=True)
        self.bigrams, self.bigram_at = np.unique(self.bigram, return_inverse=True)

    def ask(self, block: int, bits: int) -> Iterator[dict]:
        """Counts in the learned documents outside the deleted fold (`KEPT`), and in all learned documents (`LEARNED`)."""
        of = self.fold[self.row]
        for kind, hashes, at, low in ((WORDS, self.words, self.word_at, max(0, bits - 3)), (BIGRAMS, self.bigrams, self.bigram_at, bits)):
            counts = np.zeros((2, len(hashes)), np.uint32)
            for fact, which in ((KEPT, lambda f: f == 1), (LEARNED, lambda f: f > 0)):
                counts[fact] = np.bincount(at[: len(of)][which(of)], minlength=len(hashes))
                if kind == WORDS:
                    counts[fact, self.word_at[-1]] = np.count_nonzero(which(self.fold))
            yield from questions(block, kind, hashes, counts, low)

    def estimates(self, answers: pa.Table, fact: int, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For each token: its count, its bigram's estimate, its own, and the bucket of its context."""
        word = answers_of(answers, WORDS, 2)[fact].astype(np.int64)
        pair = answers_of(answers, BIGRAMS, 2)[fact].astype(np.int64)
        count = word[self.word_at[:-1]]
        context = np.concatenate([[0], count[:-1]]) if len(count) else count
        context[self.first[:-1]] = word[self.word_at[-1]]
        bigram = pair[self.bigram_at] / np.maximum(context, 1)
        return count, bigram, count / max(1, n), np.minimum(_bucket(context), _BUCKETS - 1)


def fit_weights(cells: np.ndarray, floor: float, iterations: int = ITERATIONS) -> np.ndarray:
    """Mixture weights of each bucket (rows: bigram, word, floor) by expectation-maximisation.

    cells: bucket, step of the bigram's estimate, step of the word's, number. A bucket without data takes its lower
    neighbour's weights, the lowest of these those of all data together.
    """
    value = lambda step: np.where(step > 0, 2.0 ** (-(step - 1) / 4), 0.0)

    def fit(some: np.ndarray) -> np.ndarray:
        given = np.stack([value(some[:, 1]), value(some[:, 2]), np.full(len(some), floor)])
        weight = np.full(3, 1 / 3)
        for _ in range(iterations):
            share = weight[:, None] * given
            share = share / share.sum(axis=0) * some[:, 3]
            weight = share.sum(axis=1) / some[:, 3].sum()
        weight = np.maximum(weight, 1e-6)  # nothing is impossible
        return weight / weight.sum()

    everything = fit(cells) if len(cells) else np.array([0.2, 0.7, 0.1])
    weights, last = np.empty((_BUCKETS, 3)), everything
    for bucket in range(_BUCKETS):
        own = cells[cells[:, 0] == bucket]
        last = weights[bucket] = fit(own) if len(own) else last
    return weights


def score_documents(
    documents: DataFrame, learn: Column, delete: Column, *, key: str = "doc_id", per_block: int = DOCUMENTS_PER_BLOCK
) -> DataFrame:
    """One row per document: key, learned, n_tokens, n_known, train_tokens, base_score, score.

    ``learn`` says which rows the model is learned from, ``delete`` which of them are the deleted fold; NULL counts as no.
    NULL text is empty: its one token is the end. Scores are log10; base_score is add-one smoothing of words. Repeated rows are kept and learned
    from as often as they occur. With nothing to learn from, words share one unknown type. Only key and text are
    read besides the conditions; an empty table gives an empty result. A text must fit a task's memory about a hundredfold.
    """
    kind = documents.schema[key].dataType.simpleString()
    learn, delete = F.coalesce(learn, F.lit(False)), F.coalesce(delete, F.lit(False))
    rows = documents.select(
        F.col(key).alias("key"), "text", F.when(learn & delete, 2).when(learn, 1).otherwise(0).alias("fold"),
        F.xxhash64(key, "text").alias("spread"),
    )
    n_blocks = block_count(documents.count(), per_block)
    bits = max(0, math.ceil(math.log2(n_blocks / 2)))
    # Blocks of the deleted fold are odd, so that the fit reads no others.
    some = max(1, n_blocks // 6)
    block = F.when(F.col("fold") == 2, F.pmod("spread", F.lit(some)) * 2 + 1).otherwise(F.pmod("spread", F.lit(n_blocks)) * 2)
    rows = rows.select("key", "text", "fold", block.alias("block"))
    packed = pack(rows)
    question = _arrow(documents, QUESTION)

    def ask(group: tuple, table: pa.Table) -> pa.Table:
        return table_of(_Block(table).ask(group[0].as_py(), bits), question)

    answers = stored(answered(packed.groupBy("block").applyInArrow(ask, QUESTION), 2, int(BEGIN)), "lm-counts")
    n_kept, n, v_kept, v = map(int, totals(answers, WORDS, 2))

    def cells(group: tuple, texts: pa.Table, told: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return pa.table({c: pa.array([], pa.int64()) for c in ("bucket", "b", "w", "number")})
        _, bigram, word, bucket = _Block(texts).estimates(told, KEPT, n_kept)
        step = lambda p: np.where(p > 0, np.minimum(np.rint(-np.log2(np.maximum(p, 1e-300)) * 4).astype(np.int64) + 1, _STEPS - 1), 0)
        code, number = np.unique((bucket * _STEPS + step(bigram)) * _STEPS + step(word), return_counts=True)
        return pa.table({"bucket": code // _STEPS**2, "b": code // _STEPS % _STEPS, "w": code % _STEPS, "number": number})

    odd = F.col("block") % 2 == 1
    histogram = (
        pack(rows.where(F.col("fold") == 2)).groupBy("block").cogroup(answers.where(odd).groupBy("block"))
        .applyInArrow(cells, "bucket bigint, b bigint, w bigint, number bigint")
        .groupBy("bucket", "b", "w").agg(F.sum("number").alias("number")).orderBy("bucket", "b", "w").collect()
    )
    weights = fit_weights(np.array([tuple(r) for r in histogram], np.int64).reshape(-1, 4), 1 / (v_kept + 1))
    result = f"key {kind}, learned boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    out = _arrow(documents, result)

    def score(group: tuple, texts: pa.Table, told: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return out.empty_table()
        own = _Block(texts)
        count, bigram, word, bucket = own.estimates(told, LEARNED, n)
        mix = weights[bucket]
        chance = mix[:, 0] * bigram + mix[:, 1] * word + mix[:, 2] / (v + 1)
        sums = lambda x: np.add.reduceat(x, own.first[:-1])  # noqa: E731  every row has its end token
        base = np.log10((count + 1) / (n + v + 1))
        return pa.table([
            own.rows["key"], pa.array(own.fold > 0), pa.array(np.diff(own.first)), pa.array(sums((count > 0).astype(np.int64))),
            pa.array(np.full(len(own.fold), n)), pa.array(sums(base)), pa.array(sums(np.log10(chance))),
        ], out.names).cast(out)

    scored = packed.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(score, result)
    return scored.withColumnRenamed("key", key)

