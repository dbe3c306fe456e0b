"""Passages that recur, found in suffix order and cut out.

A byte is repeated when it lies in a string of `min_bytes` that also starts elsewhere. For the suffix that starts at a place, the
longest previous factor says how much of it starts earlier too: in suffix order that is what it shares with the previous
and next suffixes at smaller places. Only whether it reaches `min_bytes` matters here, so suffixes are ordered by a 64-bit
fingerprint of their first `min_bytes` bytes, then by place. All suffixes that agree on these are neighbours, and the previous one
at a smaller place, or the next at a larger one, is the direct neighbour of the same fingerprint.

One suffix array over a corpus fits no machine, so places go to bins. A window of `min_bytes` picks the smallest hash
among its `gram`-byte strings as its anchor; equal windows pick equal anchors, so they meet in the anchor's bin, whatever is
around them. Anchors that occur once in the corpus need no bin at all (`blocks.py` counts them). Where an anchor occurs more often than
`crowd`, its windows do not go to its bin: their fingerprints are counted over the cluster, which is exact at any size. Where the
first copy stays, the block that holds the first window of a fingerprint is told so instead.

Copies of a whole text are one text here, with all its bytes repeated; where the first copy stays, all others go whole.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postgrain.llm.blocks import (
    ANSWER, DOCUMENTS_PER_BLOCK, QUESTION, answered, answers_of, block_count, distinct_texts, pack, packed_numbers, packed_sorted,
    questions, ranges, summed, table_of, to_ipc, unpacked_numbers, unpacked_sorted,
)
from postgrain.llm.chat import _arrow
from postgrain.llm.store import stored
from postgrain.llm.text import buffers, mixed, powers, running_sums

MIN_BYTES = 400
GRAM = 64
CROWD = 20_000
ANCHORS, WINDOWS, SEGMENTS, FIRSTS = 1, 2, 3, 4
# Rows of one document and text that are written out at once.
_REPEATED_ROWS = 1 << 20
_PIECE = 4 << 20
_LOW = np.uint64((1 << 24) - 1)
# The place of a NULL doc_id in the order of documents.
_LAST = 2**63 - 1


def fingerprints(raw: np.ndarray, length: int) -> np.ndarray:
    """A hash of the ``length`` bytes from each place that has as many."""
    n = len(raw)
    if n < length:
        return np.empty(0, np.uint64)
    sums = running_sums(raw)
    return mixed((sums[length:] - sums[:-length]) * powers(n - length + 1)[1])


def _lowest(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` values in a row."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.uint64(2**64 - 1))
    padded[: len(values)] = values
    rows = padded.reshape(-1, width)
    upto = np.minimum.accumulate(rows, axis=1).ravel()
    onward = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(onward[:n], upto[width - 1 : width - 1 + n])


def _anchored(raw: np.ndarray, at: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, last window, anchor) of each run of windows with one anchor; windows stay within rows."""
    if len(raw) < length:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    hashes = fingerprints(raw, gram)
    place = np.arange(len(hashes), dtype=np.uint64)
    # The place in the low bits makes the last of equal hashes the smallest.
    least = _lowest((hashes & ~_LOW) | (_LOW - place), length - gram + 1)
    size = np.diff(at)
    begins = at[:-1][size >= length]
    mark = np.zeros(len(least) + 1, np.int64)
    np.add.at(mark, begins, 1)
    np.add.at(mark, begins + size[size >= length] - length + 1, -1)
    start = np.flatnonzero(np.cumsum(mark[:-1]))
    anchor = (_LOW - (least[start] & _LOW)).astype(np.int64)
    new = np.flatnonzero((np.diff(anchor, prepend=-1) != 0) | (np.diff(start, prepend=-2) != 1))
    last = np.append(new[1:], len(start)) - 1
    return start[new], start[last], mixed(hashes[anchor[new]])


def _all_anchored(raw: np.ndarray, at: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """As `_anchored`, piece by piece. A row longer than a piece is looked at in pieces that overlap."""
    found, first = [], 0
    while first < len(at) - 1:
        last = max(first + 1, int(np.searchsorted(at, at[first] + _PIECE, "right")) - 1)
        a, b = int(at[first]), int(at[last])
        if b - a <= 2 * _PIECE:
            lo, hi, anchor = _anchored(raw[a:b], at[first : last + 1] - a, length, gram)
            found.append((lo + a, hi + a, anchor))
        else:
            for p in range(a, b - length + 1, _PIECE):
                e = min(b, p + _PIECE + length - 1)
                lo, hi, anchor = _anchored(raw[p:e], np.array([0, e - p]), length, gram)
                found.append((lo + p, hi + p, anchor))
        first = last
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _places(lo: np.ndarray, count: np.ndarray) -> np.ndarray:
    """lo[0], lo[0] + 1, ... for each run, one after the other."""
    return np.repeat(lo - (np.cumsum(count) - count), count) + np.arange(count.sum())


def _window_hashes(raw: np.ndarray, lo: np.ndarray, hi: np.ndarray, length: int) -> np.ndarray:
    """Fingerprints of all windows of these runs, with bounded scratch space."""
    out, first = [np.empty(0, np.uint64)], 0
    order = np.cumsum(hi - lo + length)
    while first < len(lo):
        last = max(first + 1, int(np.searchsorted(order, (order[first - 1] if first else 0) + _PIECE, "right")))
        size = hi[first:last] - lo[first:last] + length
        some = raw[_places(lo[first:last], size)]
        count = hi[first:last] - lo[first:last] + 1
        out.append(fingerprints(some, length)[_places(np.cumsum(size) - size, count)])
        first = last
    return np.concatenate(out)


def _repeated(fingerprint: np.ndarray, keep_first: bool) -> np.ndarray:
    """For suffixes in order of place: does the longest previous factor (or, unless the first stays, a later one) reach the length?"""
    order = np.argsort(fingerprint, kind="stable")
    same = fingerprint[order[1:]] == fingerprint[order[:-1]]
    found = np.zeros(len(order), bool)
    found[order[1:][same]] = True
    if not keep_first:
        found[order[:-1][same]] = True
    return found


def _runs(flagged: np.ndarray, lo: np.ndarray, count: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(run of windows, start, end) of what flagged windows cover; windows run after run."""
    run = np.repeat(np.arange(len(lo)), count)[flagged]
    start = _places(lo, count)[flagged]
    new = np.flatnonzero((np.diff(run, prepend=-1) != 0) | (np.diff(start, prepend=-2) != 1))
    last = np.append(new[1:], len(run)) - 1
    return (run[new], start[new], start[last] + length) if len(run) else (run, start, start)


class _Block:
    def __init__(self, payloads: pa.ChunkedArray, length: int, gram: int):
        self.rows = distinct_texts(payloads)
        self.raw, self.at = buffers(self.rows["text"].combine_chunks() if self.rows.num_rows else pa.array([], pa.string()))
        self.length, self.gram = length, gram

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return _all_anchored(self.raw, self.at, self.length, self.gram)

    def ask(self, block: int, bits: int) -> Iterator[dict]:
        hashes, counts = np.unique(self.anchors()[2], return_counts=True)
        yield from questions(block, ANCHORS, hashes, counts.astype(np.uint32)[None], bits)

    def crowded(self, told: pa.Table, crowd: int) -> tuple[np.ndarray, ...]:
        """Runs of windows with repeated anchors, and which of these are crowded."""
        lo, hi, anchor = self.anchors()
        often = answers_of(told, ANCHORS, 1)[0]
        number = often[np.unique(anchor, return_inverse=True)[1]] if len(anchor) else often
        again = number > 1
        return lo[again], hi[again], anchor[again], number[again] > crowd

    def crowded_windows(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of windows of crowded anchors: the distinct fingerprints, that of each window, the first window of each, its document."""
        hashes, of = np.unique(_window_hashes(self.raw, lo, hi, self.length), return_inverse=True)
        place = _places(lo, hi - lo + 1)
        doc = self.rows["doc_id"].combine_chunks().fill_null(_LAST).to_numpy()[np.searchsorted(self.at, place, "right") - 1]
        order = np.lexsort((place, doc, of))
        first = order[np.flatnonzero(np.diff(of[order], prepend=-1))]
        return hashes, of, first, doc[first]

    def send(self, block: int, told: pa.Table, bits: int, crowd: int, keep_first: bool) -> Iterator[dict]:
        """Texts of the runs that share an anchor, to the anchors' bins; crowded ones as fingerprints, with counts or first documents."""
        lo, hi, anchor, many = self.crowded(told, crowd)
        if keep_first:
            hashes, _, _, doc = self.crowded_windows(lo[many], hi[many])
            edges = ranges(hashes, bits)
            for owner, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                if a < b:
                    yield {"owner": owner, "block": block, "kind": FIRSTS, "hashes": packed_sorted(hashes[a:b]), "counts": packed_numbers(doc[a:b])}
        else:
            hashes, counts = np.unique(_window_hashes(self.raw, lo[many], hi[many], self.length), return_counts=True)
            yield from questions(block, WINDOWS, hashes, counts.astype(np.uint32)[None], bits)
        lo, hi, anchor = lo[~many], hi[~many], anchor[~many]
        order = np.argsort(anchor, kind="stable")
        lo, hi, anchor = lo[order], hi[order], anchor[order]
        row = np.searchsorted(self.at, lo, "right") - 1
        edges = np.searchsorted(anchor, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)) if bits else []
        for owner, (a, b) in enumerate(zip([0, *edges], [*edges, len(lo)], strict=True)):
            if a < b:
                size = hi[a:b] - lo[a:b] + self.length
                text = self.raw[_places(lo[a:b], size)]
                offsets = np.concatenate([[0], np.cumsum(size)])
                batch = pa.record_batch({
                    "first": self.rows["doc_id"].take(pa.array(row[a:b])).combine_chunks(), "row": pa.array(row[a:b]),
                    "lo": pa.array(lo[a:b] - self.at[row[a:b]]), "count": pa.array(hi[a:b] - lo[a:b] + 1),
                    "text": pa.Array.from_buffers(pa.large_binary(), b - a, [None, pa.py_buffer(offsets), pa.py_buffer(text)]),
                })
                yield {"owner": owner, "block": block, "kind": SEGMENTS, "hashes": to_ipc(batch), "counts": b""}

    def cut(self, told: pa.Table, crowd: int, keep_first: bool, with_text: bool) -> dict:
        """Repeated spans of each text and what is left."""
        n = len(self.raw)
        edge = np.zeros(n + 1, np.int64)
        key_row = np.arange(self.rows.num_rows)
        for raw in (r["counts"] for r in told.select(["kind", "counts"]).to_pylist() if r["kind"] == SEGMENTS):
            row, start, end = np.frombuffer(raw, "<i8").reshape(3, -1)
            np.add.at(edge, self.at[row] + start, 1)
            np.add.at(edge, self.at[row] + end, -1)
        if {WINDOWS, FIRSTS} & set(told["kind"].to_pylist()):
            lo, hi, _, many = self.crowded(told, crowd)
            lo, hi = lo[many], hi[many]
            if keep_first:
                _, at, first, _ = self.crowded_windows(lo, hi)
                found = np.ones(len(at), bool)
                found[first[answers_of(told, FIRSTS, 1)[0] > 0]] = False
            else:
                _, at = np.unique(_window_hashes(self.raw, lo, hi, self.length), return_inverse=True)
                found = answers_of(told, WINDOWS, 1)[0][at] > 1
            _, start, end = _runs(found, lo, hi - lo + 1, self.length)
            np.add.at(edge, start, 1)
            np.add.at(edge, end, -1)
        gone = np.cumsum(edge[:-1]) > 0
        size = np.diff(self.at)
        whole = (self.rows["copies"].to_numpy() > 1) & (size >= self.length) & (not keep_first)
        gone |= np.repeat(whole, size)
        start = gone.copy()
        row_begin = self.at[:-1][size > 0]
        start[1:] &= ~gone[:-1]
        start[row_begin] = gone[row_begin]
        close = gone.copy()
        close[:-1] &= ~gone[1:]
        row_end = self.at[1:][size > 0] - 1
        close[row_end] = gone[row_end]
        a, b = np.flatnonzero(start), np.flatnonzero(close) + 1
        of = np.searchsorted(a, self.at)
        kept, spans = [], []
        for i in key_row:
            x, y = int(self.at[i]), int(self.at[i + 1])
            kept.append(self.raw[x:y][~gone[x:y]].tobytes())
            spans.append([{"start": int(s) - x, "end": int(e) - x} for s, e in zip(a[of[i] : of[i + 1]], b[of[i] : of[i + 1]], strict=True)])
        return {
            "key": self.rows["key"], "n_bytes": size, "spans": spans, "kept_sha256": [hashlib.sha256(k).hexdigest() for k in kept],
            "kept": kept if with_text else [None] * len(kept),
        }


def _firsts(table: pa.Table) -> pa.Table:
    """Answers to blocks that told an owner the first document of each of their fingerprints: 1 for the block with the first of all."""
    table = table.sort_by("block")
    hashes = [unpacked_sorted(x.as_py()) for x in table["hashes"]]
    every = np.concatenate(hashes)
    doc = np.concatenate([unpacked_numbers(x.as_py(), np.int64) for x in table["counts"]])
    order = np.lexsort((doc, every))  # stable: the smaller block among equal documents
    first = np.zeros(len(every), np.uint32)
    first[order[np.append(True, every[order[1:]] != every[order[:-1]])]] = 1
    ends = np.cumsum([len(h) for h in hashes])
    replies = [packed_numbers(first[e - len(h) : e]) for e, h in zip(ends, hashes, strict=True)]
    return pa.table({
        "block": table["block"], "owner": table["owner"], "kind": table["kind"], "counts": pa.array(replies, pa.binary()),
        "total": pa.array([None] * len(replies), pa.binary()),
    })


def _binned(table: pa.Table, length: int, keep_first: bool) -> pa.Table:
    """A bin's repeated spans, for each block that sent text: rows, starts and ends."""
    table = table.sort_by("block")
    parts = [pa.ipc.open_stream(x.as_buffer()).read_all() for x in table["hashes"]]
    sender = np.repeat(np.arange(len(parts)), [p.num_rows for p in parts])
    lengths, hashes = [], []
    for part in parts:
        raw, at = buffers_of_binary(part["text"].combine_chunks())
        count = part["count"].to_numpy()
        hashes.append(_window_hashes(raw, at[:-1], at[:-1] + count - 1, length))
        lengths.append(count)
    every = pa.concat_tables([p.drop_columns(["text"]) for p in parts])
    count, lo, row = np.concatenate(lengths), every["lo"].to_numpy(), every["row"].to_numpy()
    first = every["first"].fill_null(_LAST).to_numpy()
    place = np.lexsort((lo, row, sender, first))  # by the document's smallest id, then by place
    begin = np.cumsum(count) - count
    windows = _places(begin[place], count[place])
    found = np.zeros(int(count.sum()), bool)
    found[windows] = _repeated(np.concatenate(hashes)[windows], keep_first)
    run, start, end = _runs(found, lo, count, length)
    replies = []
    for i in range(len(parts)):
        own = sender[run] == i
        replies.append(np.stack([row[run[own]], start[own], end[own]]).astype("<i8").tobytes())
    return pa.table({
        "block": table["block"], "owner": table["owner"], "kind": table["kind"], "counts": pa.array(replies, pa.binary()),
        "total": pa.array([None] * len(replies), pa.binary()),
    })


def buffers_of_binary(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def repeated_spans(
    documents: DataFrame, *, min_bytes: int = MIN_BYTES, gram: int = GRAM, keep_first: bool = False, crowd: int = CROWD,
    per_block: int = DOCUMENTS_PER_BLOCK, with_text: bool = False,
) -> DataFrame:
    """One row per distinct text: key (MD5 of its bytes), n_bytes, spans (start, end in bytes), kept_sha256, kept.

    Texts are whole, as UTF-8 bytes; NULL is empty. Spans are what strings of ``min_bytes`` cover that also start elsewhere in any
    text, judged on the input; with ``keep_first`` only where they start earlier, by smallest doc_id (NULL last) and place;
    the spans then are those of the text's first document, and `spans_by_document` gives all others' bytes as repeated. Texts below
    ``min_bytes`` have no spans. ``kept`` has the bytes left if ``with_text``, else NULL. Only doc_id and text are read; an empty
    table gives an empty result. ``crowd`` only chooses the way; where different texts have one doc_id (or none), which of them is
    the first may depend on ``per_block``.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    n_blocks = block_count(documents.count(), per_block)
    bits = max(0, math.ceil(math.log2(n_blocks)))
    keyed = documents.select(F.col("doc_id"), text.alias("text"), text_key(text).alias("key"))
    packed = pack(keyed.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(n_blocks))), "key")
    question = _arrow(documents, QUESTION)

    def ask(group: tuple, table: pa.Table) -> pa.Table:
        return table_of(_Block(table["payload"], min_bytes, gram).ask(group[0].as_py(), bits), question)

    anchors = stored(answered(packed.groupBy("block").applyInArrow(ask, QUESTION), 1), "repeat-anchors")

    def send(group: tuple, texts: pa.Table, told: pa.Table) -> pa.Table:
        if not told.num_rows:
            return question.empty_table()
        return table_of(_Block(texts["payload"], min_bytes, gram).send(group[0].as_py(), told, bits, crowd, keep_first), question)

    def answer(table: pa.Table) -> pa.Table:
        kind = table["kind"][0].as_py()
        return _binned(table, min_bytes, keep_first) if kind == SEGMENTS else _firsts(table) if kind == FIRSTS else summed(table, 1)

    sent = packed.groupBy("block").cogroup(anchors.groupBy("block")).applyInArrow(send, QUESTION)
    told = stored(sent.groupBy("kind", "owner").applyInArrow(answer, ANSWER), "repeat-spans")
    told = told.unionByName(anchors.join(told.where(F.col("kind").isin(WINDOWS, FIRSTS)).select("block").distinct(), "block", "left_semi"))
    result = "key binary, n_bytes bigint, spans array<struct<start:bigint,end:bigint>>, kept_sha256 string, kept binary"
    out = _arrow(documents, result)

    def cut(group: tuple, texts: pa.Table, replies: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return out.empty_table()
        return pa.table(_Block(texts["payload"], min_bytes, gram).cut(replies, crowd, keep_first, with_text)).cast(out)

    return packed.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(cut, result)


def text_key(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def _told_apart(rows: DataFrame, spans: DataFrame, min_bytes: int, with_text: bool) -> DataFrame:
    """Spans of each row where first copies stay: of rows with one text only one has the text's spans, all others go whole.

    Rows of one text are counted by doc_id before they are shuffled, and written out again in bounded runs.
    """
    counted = rows.groupBy("key", "doc_id").agg(F.count("*").alias("n"))
    # The smallest doc_id of each text; NULL where there is no other.
    least = counted.groupBy("key").agg(F.min("doc_id").alias("least"))
    counted = stored(counted.join(least, "key"), "repeat-copies")
    runs = counted.withColumn("run", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / _REPEATED_ROWS))))
    begin = F.col("run") * _REPEATED_ROWS
    each = runs.withColumn("copy", F.explode(F.sequence(begin, F.least("n", begin + _REPEATED_ROWS) - 1)))
    later = ~(F.col("doc_id").eqNullSafe(F.col("least")) & (F.col("copy") == 0)) & (F.col("n_bytes") >= min_bytes)
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end")))
    nothing = F.lit(b"")
    return each.join(spans, "key").select(
        "doc_id", "n_bytes", F.when(later, whole).otherwise(F.col("spans")).alias("spans"),
        F.when(later, F.sha2(nothing, 256)).otherwise(F.col("kept_sha256")).alias("kept_sha256"),
        (F.when(later, nothing).otherwise(F.col("kept")) if with_text else F.col("kept")).alias("kept"),
    )


def spans_by_document(documents: DataFrame, *, min_bytes: int = MIN_BYTES, keep_first: bool = False, with_text: bool = False, **options) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, spans, kept_sha256, kept.

    Options as in `repeated_spans`. With ``keep_first``, of rows with one text the one with the smallest doc_id (NULL last) has
    what that gives; every other one of at least ``min_bytes`` is removed whole. Of rows equal in both, one is the first.
    """
    spans = repeated_spans(documents, min_bytes=min_bytes, keep_first=keep_first, with_text=with_text, **options)
    rows = documents.select("doc_id", text_key(F.col("text")).alias("key"))
    rows = _told_apart(rows, spans, min_bytes, with_text) if keep_first else rows.join(spans, "key")
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"])
    return rows.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), "spans", "kept_sha256", "kept"
    )
