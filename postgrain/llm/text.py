"""Words and shingles of whole Arrow text columns, as NumPy arrays.

A word is a run of bytes other than 0x20 and 0x09-0x0D; A-Z count as a-z. Both classes are ASCII, so
UTF-8 bytes can be cut without decoding them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Text bytes that a task looks at together; a longer text is looked at alone.
SLICE_BYTES = 4 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15)


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows with at most ``most`` text bytes, or a single row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(size, dtype=np.int64)
        first = 0
        while first < batch.num_rows:
            base = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, base + most, "right")))
            yield batch.slice(first, last - first)
            first = last


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows and where each begins; NULL counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    if not len(column) or offsets is None:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.empty(0, np.uint8)
    return raw, at - at[0]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_tables: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2**64."""
    if not _tables or len(_tables[0]) < n:
        size, inverse = max(n, SLICE_BYTES + 1), np.uint64(pow(int(_BASE), -1, 1 << 64))
        _tables[:] = [np.cumprod(np.append(np.uint64(1), np.full(size - 1, b, np.uint64))) for b in (_BASE, inverse)]
    return _tables[0][:n], _tables[1][:n]


def running_sums(raw: np.ndarray) -> np.ndarray:
    """Sums of bytes times powers before each place; differences of these give the hash of any span."""
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * powers(len(raw))[0], out=sums[1:])
    return sums


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes."""
    sums = running_sums(raw)
    return mixed((sums[ends] - sums[starts]) * powers(len(raw) + 1)[1][starts] + (ends - starts).astype(np.uint64))


def words(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of each word, first word of each row plus the end)."""
    inside = ~_SPACE[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[at] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.empty(0, np.uint64), np.zeros(len(at), np.int64)
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:-1]
    lengths = np.flatnonzero(last) + 1 - starts
    place = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    powers = np.cumprod(np.full(lengths.max(), _BASE))
    terms = powers[place] * (_LOWER[raw[inside]].astype(np.uint64) + np.uint64(1))
    sums = np.add.reduceat(terms, np.cumsum(lengths) - lengths)
    return mixed(sums + lengths.astype(np.uint64)), np.searchsorted(starts, at).astype(np.int64)


def shingles(raw: np.ndarray, at: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each run of k words, its row); a row of fewer words has all of them as its one shingle."""
    word, first = words(raw, at)
    count = np.diff(first)
    row = np.repeat(np.arange(len(count)), count)
    value = np.zeros(max(0, len(word) - k + 1), np.uint64)
    for i in range(k):
        value = value * _BASE + word[i : i + len(value)]
    whole = row[: len(value)] == row[k - 1 :][: len(value)]
    values, rows = [mixed(value[whole] + np.uint64(k))], [row[: len(value)][whole]]
    for few in range(1, k):
        short = np.flatnonzero(count == few)
        value = np.zeros(len(short), np.uint64)
        for i in range(few):
            value = value * _BASE + word[first[short] + i]
        values.append(mixed(value + np.uint64(few)))
        rows.append(short)
    values, rows = np.concatenate(values), np.concatenate(rows)
    order = np.argsort(rows, kind="stable")
    return values[order], rows[order]


def sorted_sets(values: np.ndarray, rows: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct values of each row in order, row after row; where each row begins plus the end)."""
    order = np.lexsort((values, rows))
    values, rows = values[order], rows[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (rows[1:] != rows[:-1])
    values, rows = values[new], rows[new]
    return values, np.searchsorted(rows, np.arange(n_rows + 1))
