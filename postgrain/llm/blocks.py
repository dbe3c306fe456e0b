"""Blocks of texts, and questions that blocks ask of data spread over the cluster.

Some operators need, for very many hashes of each text, what the whole corpus knows of them: how often an n-gram occurs, whether a
passage recurs. A row per occurrence would be shuffled twice over. Here texts are packed into compressed blocks;
a block asks about its distinct hashes, once each, in sorted and compressed runs; the owner of a hash range sums what
all blocks say and answers each block in the order it asked. Answers need no keys, so they are small.

A block holds about `DOCUMENTS_PER_BLOCK` texts and an owner about a block's worth of hashes, however large the corpus is.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postgrain.llm.text import slices

DOCUMENTS_PER_BLOCK = 2000
PACKED = "block bigint, payload binary"
_PACK_BYTES = 16 << 20


def block_count(n_texts: int, per_block: int = DOCUMENTS_PER_BLOCK) -> int:
    return max(1, math.ceil(n_texts / per_block))


def to_ipc(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def from_ipc(payloads: Iterator) -> pa.Table:
    return pa.concat_tables([pa.ipc.open_stream(p.as_buffer()).read_all() for p in payloads])


def pack(texts: DataFrame, distinct: str | None = None) -> DataFrame:
    """Rows packed by their column ``block``: (block, payload). With ``distinct``, rows with one value of that column
    that a task sees together go in once, as the one with the smallest doc_id; a column ``copies`` counts them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in slices(batches, "text", _PACK_BYTES):
            table = pa.table(some.columns, some.schema.names)
            if distinct:
                table = table.sort_by("doc_id")
                table = table.append_column("place", pa.array(np.arange(table.num_rows)))
                first = table.group_by(distinct).aggregate([("place", "min"), ("place", "count")])
                table = table.take(first["place_min"]).drop_columns(["place"])
                table = table.append_column("copies", first["place_count"])
            number = table["block"].to_numpy()
            order = np.argsort(number, kind="stable")
            edges = np.flatnonzero(np.diff(number[order], prepend=-1)).tolist() + [len(order)]
            table = table.take(pa.array(order)).drop_columns(["block"]).combine_chunks()
            blocks, payloads = [], []
            for a, b in zip(edges, edges[1:], strict=False):
                blocks.append(int(number[order[a]]))
                payloads.append(to_ipc(pa.RecordBatch.from_struct_array(table.slice(a, b - a).to_struct_array().combine_chunks())))
            if blocks:
                yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), pa.array(payloads, pa.binary())], names=["block", "payload"])

    return texts.mapInArrow(run, PACKED)


def distinct_texts(payloads: pa.ChunkedArray) -> pa.Table:
    """What `pack` put in with ``distinct="key"``, each key once, with all its copies, in order of keys."""
    table = from_ipc(payloads).sort_by("doc_id")
    table = table.append_column("place", pa.array(np.arange(table.num_rows)))
    first = table.group_by("key").aggregate([("place", "min"), ("copies", "sum")])
    once = table.take(first["place_min"]).drop_columns(["place", "copies"]).append_column("copies", first["copies_sum"])
    return once.sort_by("key").combine_chunks()


def packed_numbers(values: np.ndarray) -> bytes:
    """Integers with the bytes of one place side by side, so that equal high bytes compress away."""
    return zstandard.compress(np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T).tobytes(), 1)


def unpacked_numbers(raw: bytes, dtype) -> np.ndarray:
    data = np.frombuffer(zstandard.decompress(raw), np.uint8)
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(data.reshape(size, -1).T).reshape(-1).view(dtype)


def packed_sorted(values: np.ndarray) -> bytes:
    return packed_numbers(np.diff(values, prepend=np.uint64(0)))


def unpacked_sorted(raw: bytes) -> np.ndarray:
    return np.cumsum(unpacked_numbers(raw, np.uint64), dtype=np.uint64)


def ranges(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Where each of 2**bits equal ranges of sorted hashes begins, plus the end."""
    edges = (np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)) if bits else np.empty(0, np.uint64)
    return np.concatenate([[0], np.searchsorted(hashes, edges), [len(hashes)]])


QUESTION = "owner bigint, block bigint, kind int, hashes binary, counts binary"
ANSWER = "block bigint, owner bigint, kind int, counts binary, total binary"


def questions(block: int, kind: int, hashes: np.ndarray, counts: np.ndarray, bits: int) -> Iterator[dict]:
    """hashes: sorted, distinct; counts: one row of uint32 per fact."""
    edges = ranges(hashes, bits)
    for owner, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
        if a < b:
            yield {
                "owner": owner, "block": block, "kind": kind, "hashes": packed_sorted(hashes[a:b]),
                "counts": packed_numbers(np.ascontiguousarray(counts[:, a:b]).reshape(-1)),
            }


def summed(table: pa.Table, facts: int, without: int | None = None) -> pa.Table:
    """Answers to all questions of one owner: for each the sums over all blocks, in its order. ``total`` of the first has what
    the owner's hashes sum to and how many have each fact, leaving the hash ``without`` out."""
    hashes = [unpacked_sorted(x.as_py()) for x in table["hashes"]]
    every = np.concatenate(hashes)
    counts = np.concatenate([unpacked_numbers(x.as_py(), np.uint32).reshape(facts, -1) for x in table["counts"]], axis=1)
    order = np.argsort(every)
    first = np.flatnonzero(np.append(True, every[order[1:]] != every[order[:-1]]))
    sums = np.add.reduceat(counts[:, order], first, axis=1, dtype=np.int64)
    kept = every[order[first]] != np.uint64(without or 0)
    total = np.concatenate([sums[:, kept].sum(axis=1), (sums[:, kept] > 0).sum(axis=1)]).astype("<i8").tobytes()
    back = np.empty((facts, len(every)), np.uint32)
    back[:, order] = np.repeat(np.minimum(sums, 2**32 - 1).astype(np.uint32), np.diff(first, append=len(every)), axis=1)
    ends = np.cumsum([len(h) for h in hashes])
    replies = [packed_numbers(np.ascontiguousarray(back[:, e - len(h) : e]).reshape(-1)) for e, h in zip(ends, hashes, strict=True)]
    return pa.table({
        "block": table["block"], "owner": table["owner"], "kind": table["kind"], "counts": pa.array(replies, pa.binary()),
        "total": pa.array([total] + [None] * (len(replies) - 1), pa.binary()),
    })


def answered(asked: DataFrame, facts: int, without: int | None = None) -> DataFrame:
    """`summed` for each owner."""
    return asked.groupBy("kind", "owner").applyInArrow(lambda table: summed(table, facts, without), ANSWER)


def answers_of(table: pa.Table, kind: int, facts: int) -> np.ndarray:
    """The block's answers of one kind, in the order of its sorted hashes."""
    rows = sorted((r for r in table.select(["kind", "owner", "counts"]).to_pylist() if r["kind"] == kind), key=lambda r: r["owner"])
    parts = [unpacked_numbers(r["counts"], np.uint32).reshape(facts, -1) for r in rows]
    return np.concatenate(parts, axis=1) if parts else np.empty((facts, 0), np.uint32)


def totals(answers: DataFrame, kind: int, facts: int) -> np.ndarray:
    """Summed totals of a kind: the facts' sums, then how many hashes have each fact. One row per owner reaches the driver."""
    out = np.zeros(2 * facts, np.int64)
    for row in answers.where((F.col("kind") == kind) & F.col("total").isNotNull()).select("total").toLocalIterator():
        out += np.frombuffer(row["total"], "<i8")
    return out


def table_of(rows: Iterator[dict], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_pylist(list(rows), schema)
