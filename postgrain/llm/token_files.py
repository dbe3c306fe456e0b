"""Token ids as wavelet matrices, one compressed file per shard.

A shard holds the ids of a run of documents in order. Its wavelet matrix has a bit plane for each id bit, the highest first;
below each plane the zeros come before the ones. With a directory of ones per 512 bits it answers from the file: the id at a
place, how often an id occurs before a place, and where its n-th occurrence is.

File: ``PGWM``, length of the header (4 bytes, little endian), JSON header (ids, bits, documents, sizes of parts), then
zstandard frames: the doc_ids, the documents' lengths, and each plane's bits packed from the lowest.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from postgrain.llm.store import shared_dir
from postgrain.llm.text import buffers, slices, span_hashes

MAGIC = b"PGWM"
TOKENIZER = "byte_bpe_50k.json"
END_ID = 0
_BLOCK = 512
# Pieces whose ids a Python worker remembers, some 35 bytes each.
REMEMBERED = 2_000_000


class WaveletMatrix:
    def __init__(self, n: int, planes: list[np.ndarray]):
        """planes: packed bits, the highest id bit first."""
        self.n, self.planes, self.depth = n, planes, len(planes)
        self._ones: dict[int, np.ndarray] = {}

    @classmethod
    def build(cls, ids: np.ndarray, depth: int) -> WaveletMatrix:
        planes, level = [], ids
        for bit in range(depth - 1, -1, -1):
            ones = (level & level.dtype.type(1 << bit)) != 0
            planes.append(np.packbits(ones, bitorder="little"))
            # Places are found and taken faster than a mask is applied.
            level = np.concatenate([level[np.flatnonzero(~ones)], level[np.flatnonzero(ones)]])
        return cls(len(ids), planes)

    def all(self) -> np.ndarray:
        """Every id in order: from the lowest plane up, each level is merged back from its zeros and ones."""
        level = np.zeros(self.n, np.uint16 if self.depth <= 16 else np.uint32)
        for bit, plane in enumerate(reversed(self.planes)):
            ones = np.unpackbits(plane, count=self.n, bitorder="little").view(bool)
            zeros = self.n - int(np.count_nonzero(ones))
            up = np.empty_like(level)
            up[np.flatnonzero(~ones)] = level[:zeros]
            up[np.flatnonzero(ones)] = level[zeros:] | level.dtype.type(1 << bit)
            level = up
        return level

    def _directory(self, k: int) -> np.ndarray:
        """Ones before each block of plane k, and in all."""
        if k not in self._ones:
            bits = np.unpackbits(self.planes[k], count=self.n, bitorder="little")
            per = np.add.reduceat(bits, np.arange(0, self.n, _BLOCK), dtype=np.int64) if self.n else np.empty(0, np.int64)
            self._ones[k] = np.concatenate([[0], np.cumsum(per)])
        return self._ones[k]

    def _rank(self, k: int, i: int) -> int:
        """Ones of plane k before place i."""
        block = i // _BLOCK
        rest = np.unpackbits(self.planes[k][block * _BLOCK // 8 : (i + 7) // 8], count=i - block * _BLOCK, bitorder="little")
        return int(self._directory(k)[block]) + int(rest.sum())

    def _select(self, k: int, one: bool, j: int) -> int:
        """Place of the j-th (from 0) bit of that value in plane k."""
        ones = self._directory(k)
        before = ones if one else np.minimum(np.arange(len(ones)) * _BLOCK, self.n) - ones
        block = int(np.searchsorted(before, j, "right")) - 1
        end = min(self.n, (block + 1) * _BLOCK)
        bits = np.unpackbits(self.planes[k][block * _BLOCK // 8 : (end + 7) // 8], count=end - block * _BLOCK, bitorder="little")
        return block * _BLOCK + int(np.flatnonzero(bits == one)[j - int(before[block])])

    def _zeros(self, k: int) -> int:
        return self.n - int(self._directory(k)[-1])

    def access(self, i: int) -> int:
        value = 0
        for k in range(self.depth):
            ones = self._rank(k, i)
            bit = self.planes[k][i // 8] >> (i % 8) & 1
            value, i = value * 2 + int(bit), self._zeros(k) + ones if bit else i - ones
        return value

    def _narrow(self, value: int, end: int) -> tuple[int, int]:
        first = 0
        for k in range(self.depth):
            a, b = self._rank(k, first), self._rank(k, end)
            if value >> (self.depth - 1 - k) & 1:
                first, end = self._zeros(k) + a, self._zeros(k) + b
            else:
                first, end = first - a, end - b
        return first, end

    def count(self, value: int, end: int | None = None) -> int:
        """Occurrences of an id before place ``end``."""
        first, last = self._narrow(value, self.n if end is None else end)
        return last - first

    def locate(self, value: int, j: int) -> int:
        """Place of the j-th (from 0) occurrence of an id."""
        first, last = self._narrow(value, self.n)
        if not 0 <= j < last - first:
            raise IndexError(j)
        place = first + j
        for k in range(self.depth - 1, -1, -1):
            one = bool(value >> (self.depth - 1 - k) & 1)
            place = self._select(k, one, place - self._zeros(k) if one else place)
        return place


def to_bytes(ids: np.ndarray, doc_ids: list, lengths: np.ndarray, depth: int) -> bytes:
    matrix = WaveletMatrix.build(ids, depth)
    pack = zstandard.ZstdCompressor(level=1).compress
    parts = [pack(json.dumps(doc_ids).encode()), pack(lengths.astype("<i8").tobytes()), *(pack(p.tobytes()) for p in matrix.planes)]
    head = json.dumps({"ids": len(ids), "bits": depth, "documents": len(doc_ids), "parts": [len(p) for p in parts]}).encode()
    return b"".join([MAGIC, struct.pack("<I", len(head)), head, *parts])


def from_bytes(content: bytes) -> tuple[list, np.ndarray, WaveletMatrix]:
    """(doc_ids, lengths, matrix)"""
    if content[:4] != MAGIC:
        raise ValueError("not a token file")
    size = struct.unpack("<I", content[4:8])[0]
    head = json.loads(content[8 : 8 + size])
    at, parts = 8 + size, []
    for n in head["parts"]:
        parts.append(zstandard.decompress(content[at : at + n]))
        at += n
    planes = [np.frombuffer(p, np.uint8) for p in parts[2:]]
    return json.loads(parts[0]), np.frombuffer(parts[1], "<i8"), WaveletMatrix(head["ids"], planes)


class Encoder:
    """Token ids of whole texts; each distinct piece of a text is encoded once, and remembered.

    A text is cut only where the tokenizer's own pattern always cuts: before a space that stands alone between two characters
    that are no white space, around a line feed that does, and where ASCII letters (or U+00C0-U+00FF letters on the left), digits and
    other ASCII signs meet, but for an apostrophe on the left, which may begin a contraction. So the pieces' ids in a row are the
    whole text's. Pieces are told apart by 64-bit hashes.

    The tokenizer's added tokens (such as <|endoftext|>) are found in texts first, as the library does, and are pieces of their own;
    the rest is cut as if texts began and ended there.
    """

    _LETTER, _DIGIT, _SIGN, _APOSTROPHE = (np.zeros(256, bool) for _ in range(4))
    _LETTER[[*range(65, 91), *range(97, 123)]] = True
    _DIGIT[48:58] = True
    _SIGN[0x21:0x7F] = True
    _SIGN &= ~_LETTER & ~_DIGIT
    _APOSTROPHE[0x27] = True

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size()
        added = list(self.tokenizer.get_added_tokens_decoder().values())
        if any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in added):
            raise ValueError("added tokens that take their surroundings into account, or are normalized, are not supported")
        self.added = sorted((t.content for t in added), key=len, reverse=True)  # of those that begin at one place the longest is taken
        self.finder = re.compile(b"|".join(re.escape(t.encode()) for t in self.added))
        self.forget()

    def forget(self) -> None:
        self.known = np.empty(0, np.uint64)  # sorted hashes of pieces
        self.begin, self.size = np.empty(0, np.int64), np.empty(0, np.int64)  # where their ids are
        self.flat = np.empty(0, np.uint16 if self.vocabulary <= 1 << 16 else np.uint32)

    def _added(self, texts: pa.Array, raw: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, int]]:
        """Where added tokens begin and end."""
        holds = np.zeros(len(texts), bool)
        for token in self.added:
            holds |= pc.fill_null(pc.match_substring(texts, token), False).to_numpy(zero_copy_only=False)
        for row in np.flatnonzero(holds):
            first = int(at[row])
            for found in self.finder.finditer(raw[first : at[row + 1]].tobytes()):
                yield first + found.start(), first + found.end()

    def _cuts(self, raw: np.ndarray, at: np.ndarray, added: Iterable[tuple[int, int]]) -> np.ndarray:
        cut = np.zeros(len(raw) + 1, bool)
        letter, digit, sign = self._LETTER[raw], self._DIGIT[raw], self._SIGN[raw]
        left = letter.copy()
        left[1:] |= (raw[:-1] == 0xC3) & (raw[1:] != 0x97) & (raw[1:] != 0xB7)
        cut[1:-1] = left[:-1] & (sign | digit)[1:] | digit[:-1] & (letter | sign)[1:] | (sign & ~self._APOSTROPHE[raw])[:-1] & (letter | digit)[1:]
        solid = left | digit | sign
        after = (letter | digit | sign | (raw >= 0xC3) & (raw <= 0xDF))[2:]
        alone = solid[:-2] & after
        cut[1:-2] |= alone & ((raw[1:-1] == 0x20) | (raw[1:-1] == 0x0A))
        cut[2:-1] |= alone & (raw[1:-1] == 0x0A)
        for begin, end in added:
            cut[begin : end + 1] = False
            cut[[begin, end]] = True
        cut[at] = True
        return np.flatnonzero(cut)

    def _learn(self, hashes: np.ndarray, pieces: list[str]) -> None:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        size = np.fromiter(map(len, found), np.int64, len(found))
        begin = len(self.flat) + np.cumsum(size) - size
        self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(found), self.flat.dtype, int(size.sum()))])
        order = np.argsort(hashes)
        place = np.searchsorted(self.known, hashes[order])
        self.known = np.insert(self.known, place, hashes[order])
        self.begin = np.insert(self.begin, place, begin[order])
        self.size = np.insert(self.size, place, size[order])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, number of ids of each)"""
        raw, at = buffers(texts)
        if len(raw) < 3:  # too short for the cuts to be looked for
            raw, at, pad = np.concatenate([raw, np.full(3, 0x20, np.uint8)]), np.append(at, len(raw) + 3), 1
        else:
            pad = 0
        cuts = self._cuts(raw, at, self._added(texts, raw, at))
        coded = pa.array(span_hashes(raw, cuts[:-1], cuts[1:])).dictionary_encode()
        hashes, index = coded.dictionary.to_numpy(), coded.indices.to_numpy()
        if len(self.known) + len(hashes) > REMEMBERED:
            self.forget()
        at_known = np.minimum(np.searchsorted(self.known, hashes), max(0, len(self.known) - 1))
        new = np.flatnonzero(self.known[at_known] != hashes) if len(self.known) else np.arange(len(hashes))
        if len(new):
            first = np.empty(len(hashes), np.int64)
            first[index[::-1]] = np.arange(len(index) - 1, -1, -1)
            some = raw.tobytes()
            starts, ends = cuts[first[new]].tolist(), cuts[first[new] + 1].tolist()
            self._learn(hashes[new], [some[a:b].decode() for a, b in zip(starts, ends, strict=True)])
            at_known = np.searchsorted(self.known, hashes)
        sizes = self.size[at_known][index]
        ends = np.cumsum(sizes)
        ids = self.flat[np.repeat(self.begin[at_known][index] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]
        upto = np.concatenate([[0], ends])[np.searchsorted(cuts, at)]
        sizes = np.diff(upto)
        return (ids[: upto[-2]], sizes[:-1]) if pad else (ids, sizes)


@cache
def _encoder(path: str) -> Encoder:
    """One for all tasks of a Python worker."""
    return Encoder(path)


def _with_ends(ids: np.ndarray, sizes: np.ndarray, end_id: int) -> np.ndarray:
    return np.insert(ids, np.cumsum(sizes), end_id)


def write_token_files(documents: DataFrame, path: str, *, tokenizer: str = TOKENIZER, end_id: int = END_ID) -> DataFrame:
    """Encode all texts, by doc_id, into wavelet files below ``path``: one row per file (shard, file, documents, ids).

    Shards are ranges of doc_id in order. NULL doc_id goes first; equal doc_ids follow the hash of their text, so that
    repeated rows are kept, side by side. NULL text is the end id alone. Files take their final name when they are
    whole, so a task that runs again replaces its file by an equal one. Spark cuts as many shards as the session
    has shuffle partitions; a task holds one shard's ids. Other columns are ignored; an empty table writes no file.
    """
    from pyarrow import fs

    at = public_tokenizers.path(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(at)
        depth = max(1, (encoder.vocabulary - 1).bit_length())
        kind = np.uint16 if depth <= 16 else np.uint32
        doc_ids, lengths, ids = [], [], []
        for some in slices(batches, "text"):
            found, sizes = encoder.encode(some["text"])
            doc_ids += some["doc_id"].to_pylist()
            lengths.append(sizes + 1)
            ids.append(_with_ends(found, sizes, end_id).astype(kind))
        if not doc_ids:
            return
        shard = TaskContext.get().partitionId()
        content = to_bytes(np.concatenate(ids), doc_ids, np.concatenate(lengths), depth)
        store, folder = fs.FileSystem.from_uri(path)
        store.create_dir(folder, recursive=True)
        final = f"{folder}/shard-{shard:08d}.pgwm"
        part = f"{folder}/_{uuid.uuid4().hex}"
        with store.open_output_stream(part) as out:
            out.write(content)
        store.move(part, final)
        yield pa.RecordBatch.from_pydict({
            "shard": pa.array([shard], pa.int64()), "file": pa.array([os.path.basename(final)]),
            "documents": pa.array([len(doc_ids)], pa.int64()), "ids": pa.array([sum(map(len, ids))], pa.int64()),
        })

    rows = documents.select("doc_id", "text")
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    return (
        rows.repartitionByRange(*order).sortWithinPartitions(*order)
        .mapInArrow(run, "shard bigint, file string, documents bigint, ids bigint")
    )


def read_token_files(spark, path: str) -> DataFrame:
    """One row per document from the files: doc_id, shard, position, start, n_tokens, ids_crc32."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"], strict=True):
                doc_ids, lengths, matrix = from_bytes(content.as_buffer().to_pybytes())
                ids, ends = matrix.all(), np.cumsum(lengths)
                crc = [zlib.crc32(ids[e - n : e].astype("<u4")) for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
                shard = int(name.as_py().rpartition("-")[2].removesuffix(".pgwm"))
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(doc_ids, pa.int64()), "shard": pa.array([shard] * len(crc), pa.int64()),
                    "position": pa.array(range(len(crc)), pa.int64()), "own_start": pa.array(ends - lengths, pa.int64()),
                    "n_tokens": pa.array(lengths, pa.int64()), "ids_crc32": pa.array(crc, pa.int64()),
                })

    files = spark.read.format("binaryFile").option("pathGlobFilter", "shard-*.pgwm").load(path)
    return files.select("path", "content").mapInArrow(
        run, "doc_id bigint, shard bigint, position bigint, own_start bigint, n_tokens bigint, ids_crc32 bigint"
    )


def token_index(documents: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Write the files, then read them back: doc_id, start, n_tokens, ids_crc32, shard, position, in any row order."""
    spark = documents.sparkSession
    path = path or shared_dir(spark, "token-files")
    written = write_token_files(documents, path, **options).collect()  # one small row per file
    if not written:
        return spark.createDataFrame([], "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint, shard bigint, position bigint")
    totals = spark.createDataFrame([(w["shard"], w["ids"]) for w in written], "shard bigint, ids bigint")
    before = F.coalesce(F.sum("ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = totals.select("shard", before.alias("shard_start"))
    return (
        read_token_files(spark, path).join(F.broadcast(starts), "shard")
        .select("doc_id", (F.col("shard_start") + F.col("own_start")).alias("start"), "n_tokens", "ids_crc32", "shard", "position")
    )
