"""N-gram Jaccard join by universe partition.

Sets of a and b shingles with a Jaccard similarity of 3/4 or more differ in at most (a + b) / 7 shingles. Hash the universe of
shingles into segments: each difference falls into one of them, so if there are more segments than differences, two similar sets
agree on some segment. A segment may instead be worth two: if sets also agree when one shingle is left out on either side
(its one-deletion neighbourhood), it takes two differences to spoil it.

Sizes are banded, since the number of differences depends on them: a pair belongs to the band of its smaller set, and a
set takes part in its own band and in the one below if it may be the larger set there. For each band, `allocation` weighs
how many segments to index exactly and how many with their deletions, by expected signatures; small sets may be cheapest with each
shingle a segment of its own.

Agreement on nothing (both segments empty, or both of one shingle when one may go) proves nothing. So there are more segments than
differences by a `slack`; as long as either set has no more such segments than that, the two agree on a segment that says
something. The same slack pays for crowded signatures, those of more than `CROWD` groups that are not yet linked: they are
left out for sets that can afford it. Sets that cannot, go by single shingles, and those that have too many crowded ones even there
by their rarest shingles, counted among these sets: of two similar sets, the smaller one shares a shingle of its rarest seventh
with the rarest quarter of the larger one, and where the last shared ones stand in the two tells how many more there can be.

First a few signatures of each set link most near copies to one of them, so that thousands of copies are one group when
all segments are compared; pairs within a group need no comparison. Two similar sets agree on more segments than either's
slack, so pairs of different groups that share fewer signatures are dropped. Most of the pairs left are still no links, and short maps
of the sets tell that of nearly all: a bit of a map is set where an odd number of shingles hashes to it, so two maps differ in no more
bits than the sets in shingles. The links are verified on the sets.

Half of its slack a set spends beforehand: that many of its largest signatures are not sent. Of what two sets share, either then
misses some of the largest, so together they miss no more than the one with more slack does, and share more than what is left of it.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postgrain.llm.blocks import from_ipc, packed_numbers, packed_sorted, to_ipc, unpacked_numbers, unpacked_sorted
from postgrain.llm.components import components
from postgrain.llm.repeats import text_key
from postgrain.llm.store import stored
from postgrain.llm.text import buffers, mixed, shingles, slices, sorted_sets

K = 5
CROWD = 16
# Signatures of each set that the first rounds compare, and these rounds.
FIRST, ROUNDS = 6, 2
# Signatures that one task matches, on average, and a guess of how many a document has.
MATCHED, EXPECTED = 1_500_000, 300
# Nodes sent to all tasks at most; beyond that the join shuffles texts.
BROADCAST_NODES = 500_000
_SLICE = 2 << 20
# Pairs that a Python worker gets at once, each with two whole sets; and with two maps.
_PAIRS, _MAPPED = 256, 2048
# Bits of a set's map for each shingle at least, and of one map.
_SPREAD, _LEAST_BITS, _MOST_BITS = 4, 64, 1 << 14
# 64-bit words of the maps that sets bring to the comparison by rarest shingles.
_WORDS = 8
# Nodes of a shingle that are compared with all others of it at once.
_BLOCK = 500
# Pairs that a task notes before it counts equal ones together.
_WAITING = 500_000


def similar(common, a, b):
    """Jaccard similarity of 3/4 or more, in whole numbers."""
    return 100 * common >= 75 * (a + b - common)


def bands(most: int) -> np.ndarray:
    """Smallest size of each band, up to the one that holds ``most``, and the next."""
    edges = [1]
    while edges[-1] <= most:
        edges.append(max(edges[-1] + 1, math.ceil(1.5 * edges[-1])))
    return np.array(edges)


@cache
def allocation(low: int, high: int) -> tuple[int, int, int, int] | None:
    """(segments with deletions, their share of the universe over an exact one's, exact segments, slack), or None for single shingles.

    The cost is what a set of middle size has to expect: its signatures, and once more those of a single shingle, which
    common phrases make crowded. The smallest set may exceed its slack by chance only as three standard deviations are exceeded.
    """
    differences = (high + high * 4 // 3) // 7
    best, cost = None, float(low + high)
    for deletions in sorted({round((differences + 1) * f / 8) for f in range(13)}):
        for share in (1, 2, 3, 4) if deletions else (1,):
            exact = max(0, differences + 1 - 2 * deletions)
            while True:
                parts = deletions * share + exact
                if parts > 4 * high + 8:
                    break
                one = low / max(1, parts)
                alone = parts == deletions == 1 and low > 2  # the whole set is the one segment
                empty, few = (0.0, 0.0) if alone else (math.exp(-one), math.exp(-one * share) * (1 + one * share))
                mean = exact * empty + 2 * deletions * few
                spread = math.sqrt(exact * empty * (1 - empty) + 4 * deletions * few * (1 - few))
                slack = 2 * deletions + exact - differences - 1
                if slack >= mean + 3 * spread:
                    middle = (low + high) / 2 / parts
                    wide = middle * share
                    price = exact * (1 - math.exp(-middle) + middle * math.exp(-middle))
                    price += deletions * (wide + 1 + (0 if alone else (wide + wide**2) * math.exp(-wide)))
                    if price < cost:
                        best, cost = (deletions, share, exact, slack), price
                    break
                exact += max(1, exact // 50)
    return best


def _halved(sig: np.ndarray, row: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Signatures without the largest of each row, half as many as its slack; and the slack that is left."""
    order = np.lexsort((sig, row))
    sig, row = sig[order], row[order]
    drop = np.maximum(left, 0) // 2
    keep = np.arange(len(row)) < (np.cumsum(np.bincount(row, minlength=len(left))) - drop)[row]
    return sig[keep], row[keep], left - drop


def signatures(values: np.ndarray, at: np.ndarray, single: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of sorted sets: (signature, row), and (row, slack left) of each set in each of its bands, half of the slack being spent.

    With ``single``, each shingle is a segment of its own, the same in all bands.
    """
    size = np.diff(at)
    edges = bands(int(size.max(initial=1)))
    own = np.searchsorted(edges, size, "right") - 1
    sigs, rows, takes, left = [], [], [], []
    for lower in (0,) if single else (0, 1):
        band = own - lower
        taking = (size > 0) & (band >= 0)
        if lower:
            taking &= 4 * (edges[np.maximum(own, 0)] - 1) >= 3 * size
        for b in np.unique(band[taking]):
            chosen = np.flatnonzero(taking & (band == b))
            lengths = size[chosen]
            begin = np.cumsum(lengths) - lengths
            some = values[np.repeat(at[chosen] - begin, lengths) + np.arange(lengths.sum())]
            row = np.repeat(np.arange(len(chosen)), lengths)
            salt = mixed(np.array([1 << 40 if single else int(b) * 2 + 1], np.uint64))
            plan = None if single else allocation(int(edges[b]), int(edges[b + 1] - 1))
            takes.append(chosen)
            if plan is None:
                sig, row, spare = _halved(mixed(some ^ salt), row, (3 * lengths + 3) // 4 - 1)
                sigs.append(sig)
                rows.append(chosen[row])
                left.append(spare)
                continue
            deletions, share, exact, slack = plan
            # The universe in equal parts; a segment with deletions is ``share`` of them. Sorted sets keep segments together.
            part = ((some >> np.uint64(32)) * np.uint64(deletions * share + exact) >> np.uint64(32)).astype(np.int64)
            segment = np.where(part < deletions * share, part // share, part - deletions * (share - 1))
            first = np.flatnonzero(np.append(True, (np.diff(row) != 0) | (np.diff(segment) != 0)))
            count = np.diff(first, append=len(some))
            token = mixed(some ^ salt)
            total = np.add.reduceat(token, first) if len(first) else token
            name = mixed(segment[first].astype(np.uint64) + salt)
            sig, of = [mixed(total ^ name)], [row[first]]
            loose = segment[first] < deletions
            if deletions:
                again = np.repeat(loose & (count > 1), count)
                sig.append(mixed((np.repeat(total, count) - token)[again] ^ np.repeat(name, count)[again]))
                of.append(row[again])
            present = np.bincount(row[first][~loose], minlength=len(chosen))
            firm = np.bincount(row[first][loose & (count > 1)], minlength=len(chosen))
            spare = slack - (exact - present) - 2 * (deletions - firm)
            # A signature may stand for two where one shingle may go.
            sig, of, spare = _halved(np.concatenate(sig), np.concatenate(of), spare // 2 if deletions else spare)
            sigs.append(sig)
            rows.append(chosen[of])
            left.append(spare)
    join = lambda x, kind: np.concatenate(x) if x else np.empty(0, kind)
    return join(sigs, np.uint64), join(rows, np.int64), join(takes, np.int64), join(left, np.int64)


class _Sets:
    """Shingle sets of a slice of texts, each text once."""

    def __init__(self, batch: pa.RecordBatch):
        table = pa.table(batch.columns, batch.schema.names)
        table = table.append_column("place", pa.array(np.arange(table.num_rows)))
        self.rows = table.take(table.group_by("key").aggregate([("place", "min")])["place_min"]).combine_chunks()
        values, row = shingles(*buffers(self.rows["text"].combine_chunks()), K)
        self.values, self.at = sorted_sets(values, row, self.rows.num_rows)
        self.size = np.diff(self.at)
        raw = memoryview(self.values).cast("B")
        name = [hashlib.blake2b(raw[8 * a : 8 * b], digest_size=8).digest() for a, b in zip(self.at.tolist(), self.at[1:].tolist(), strict=False)]
        self.node = np.frombuffer(b"".join(name), "<i8")

    def once(self) -> tuple[np.ndarray, np.ndarray]:
        """(values, at) with sets after the first of a node left out as empty ones."""
        first = np.zeros(len(self.node), bool)
        first[np.unique(self.node, return_index=True)[1]] = True
        size = np.where(first, self.size, 0)
        return self.values[np.repeat(first, self.size)], np.concatenate([[0], np.cumsum(size)])


_KEYED = "kind int, owner bigint, payload binary, nodes binary"
LINK = "a bigint, b bigint"


def _payloads(sig: np.ndarray, row: np.ndarray, bits: int, **of_row: np.ndarray) -> Iterator[tuple]:
    order = np.argsort(sig)
    sig, row = sig[order], row[order]
    edges = [0, *(np.searchsorted(sig, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)) if bits else []), len(sig)]
    for owner, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
        if a < b:
            there, local = np.unique(row[a:b], return_inverse=True)
            nodes = pa.record_batch({name: values[there] for name, values in of_row.items()})
            payload = pa.record_batch({"sig": pa.array([packed_sorted(sig[a:b])]), "row": pa.array([packed_numbers(local.astype(np.uint32))])})
            yield 1, owner, to_ipc(payload), to_ipc(nodes)


def _emit(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.binary()), pa.array(columns[3], pa.binary())],
        names=["kind", "owner", "payload", "nodes"],
    )


def _met(table: pa.Table) -> tuple[np.ndarray, np.ndarray, pa.Table]:
    """Of signatures that two nodes or more share: (where each begins plus the end; the signatures and their nodes, in order)."""
    nodes, sigs, at, seen = [], [], [], 0
    for payload, who in zip(table["payload"], table["nodes"], strict=True):
        own = pa.ipc.open_stream(payload.as_buffer()).read_all()
        sigs.append(unpacked_sorted(own["sig"][0].as_py()))
        at.append(unpacked_numbers(own["row"][0].as_py(), np.uint32).astype(np.int64) + seen)
        nodes.append(pa.ipc.open_stream(who.as_buffer()).read_all())
        seen += nodes[-1].num_rows
    every, sig, place = pa.concat_tables(nodes).combine_chunks(), np.concatenate(sigs), np.concatenate(at)
    order = np.argsort(sig)
    sig, place = sig[order], place[order]
    same = sig[1:] == sig[:-1]
    shared = np.append(same, False) | np.append(False, same)
    sig, place = sig[shared], place[shared]
    node = every["node"].to_numpy()[place]
    order = np.lexsort((node, sig))
    sig, node, place = sig[order], node[order], place[order]
    once = np.append(True, (sig[1:] != sig[:-1]) | (node[1:] != node[:-1])) if len(sig) else np.empty(0, bool)
    sig, place = sig[once], place[once]
    begin = np.flatnonzero(np.append(True, sig[1:] != sig[:-1])) if len(sig) else np.empty(0, np.int64)
    return np.append(begin, len(sig)), sig, every.take(pa.array(place))


def _members(table: pa.Table) -> pa.Table:
    """The nodes of each signature that two or more share."""
    begin, sig, nodes = _met(table)
    many = np.repeat(np.diff(begin) > 1, np.diff(begin))
    kept = nodes.filter(pa.array(many))
    return pa.table({"sig": sig[many].view(np.int64), "node": kept["node"], "size": kept["size"]})


def _fit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether sets of these sizes can be similar."""
    return 4 * np.minimum(a, b) >= 3 * np.maximum(a, b)


def _across(table: pa.Table, crowd: int) -> pa.Table:
    """(a, b, times, need): pairs of nodes of different groups, the signatures that they share here, and how many they must share
    everywhere; for crowded signatures (NULL b) the nodes alone and the number of these."""
    begin, _, nodes = _met(table)
    node, group, size, left = (nodes[c].to_numpy() for c in ("node", "group", "size", "left"))
    group = np.where(group == 0, node, group)
    one, two, lone, waiting = [], [], [np.empty(0, np.int64)], 0
    met = np.empty((0, 4), np.int64)  # a, b, times, need of each pair so far

    def merged() -> np.ndarray:
        a, b = (np.concatenate([np.empty(0, np.int64), *x]) for x in (one, two))
        rows = np.stack([node[a], node[b], np.ones(len(a), np.int64), np.maximum(left[a], left[b]) + 1], axis=1)
        rows = np.concatenate([met, rows])
        pairs, first, at = np.unique(rows[:, :2], axis=0, return_index=True, return_inverse=True)
        times = np.bincount(at.ravel(), rows[:, 2], len(pairs)).astype(np.int64)
        return np.column_stack([pairs, times, rows[first, 3]])

    for x, y in zip(begin.tolist(), begin[1:].tolist(), strict=False):
        own = group[x:y]
        if y - x < 2 or (own == own[0]).all():
            continue
        if y - x > crowd and len(np.unique(own)) > crowd:
            lone.append(np.arange(x, y))
            continue
        for i in range(x, y - 1):
            other = np.flatnonzero(group[i + 1 : y] != group[i]) + i + 1
            other = other[_fit(size[other], size[i])]
            one.append(np.full(len(other), i))
            two.append(other)
            waiting += len(other)
            if waiting > _WAITING:
                met, one, two, waiting = merged(), [], [], 0
    met = merged()
    pairs, times, need = met[:, :2], met[:, 2], met[:, 3]
    who, often = np.unique(node[np.concatenate(lone)], return_counts=True)
    return pa.table({
        "a": np.concatenate([pairs[:, 0], who]), "b": pa.array([*pairs[:, 1].tolist(), *[None] * len(who)], pa.int64()),
        "times": np.concatenate([times, often]), "need": np.concatenate([need, np.zeros(len(who), np.int64)]),
    })


def _bits(n: int) -> int:
    return max(0, round(math.log2(max(1, n * EXPECTED / MATCHED))))


def _mask(n: int) -> np.uint64:
    """Which bits of a signature are sent: enough for a few thousand pairs in all to agree on these by chance, which are then verified."""
    spared = min(24, max(0, 76 - 2 * math.ceil(math.log2(max(2, n * EXPECTED)))))
    return np.uint64(2**64 - (1 << spared))


def _beside(texts: DataFrame, side: DataFrame, how: str) -> DataFrame:
    """Texts joined to a stored table by key. A side of checked size goes to all tasks, so that texts are not shuffled."""
    return texts.join(_small(side), "key", how)


def _sent(
    texts: DataFrame, bits: int, mask: np.uint64, first: int | None = None, single: bool = False, report: bool = True
) -> DataFrame:
    """Signatures packed by owner (kind 1). With ``report`` also, for each text, its node and size, and the least slack that it has in a
    band (kind 0)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", _SLICE):
            sets = _Sets(batch)
            rows = []
            named = "root" in sets.rows.column_names
            group = sets.rows["root"].combine_chunks().fill_null(0).to_numpy() if named else sets.node
            group = np.where(group == sets.node, 0, group)  # 0: the node itself
            sig, row, takes, slack = signatures(*sets.once(), single=single)
            sig &= mask
            left = np.full(len(sets.node), np.iinfo(np.int64).max)
            np.minimum.at(left, takes, slack)
            # Signatures of a set that the mask makes one count once where they are shared.
            np.subtract.at(left, row[1:][(row[1:] == row[:-1]) & (sig[1:] == sig[:-1])], 1)
            if report:
                told = pa.record_batch({"key": sets.rows["key"].combine_chunks(), "node": sets.node, "size": sets.size, "left": left})
                rows.append((0, -1, to_ipc(told), None))
            if first is not None:  # the smallest few of each set; which these are depends on the signatures alone
                order = np.lexsort((sig, row))
                sig, row = sig[order], row[order]
                rank = np.arange(len(row)) - np.searchsorted(row, row)
                sig, row = sig[rank < first], row[rank < first]
            rows += _payloads(sig, row, bits, node=sets.node, group=group, size=sets.size, left=left)
            yield _emit(rows)

    return texts.mapInArrow(run, _KEYED)


def _reported(sent: DataFrame, schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from from_ipc(batch["payload"]).to_batches()

    return sent.where(F.col("kind") == 0).select("payload").mapInArrow(run, schema)


def _small(side: DataFrame) -> DataFrame:
    """A stored side for a broadcast where its checked size allows one."""
    return F.broadcast(side) if side.count() <= BROADCAST_NODES else side


def _maps(values: np.ndarray, at: np.ndarray, least: int = _LEAST_BITS, most: int = _MOST_BITS) -> list[bytes]:
    """Of each set, the bits that an odd number of its shingles hash to; a power of two of these, by size."""
    size = np.diff(at)
    bits = np.left_shift(1, np.ceil(np.log2((size * _SPREAD).clip(least, most))).astype(np.int64))
    ends = np.cumsum(bits)
    odd = np.zeros(int(bits.sum()), np.uint8)
    place = np.repeat(ends - bits, size) + (values[at[0] : at[-1]] & np.repeat((bits - 1).astype(np.uint64), size)).astype(np.int64)
    np.add.at(odd, place, np.uint8(1))  # what overflows is even
    packed = np.packbits(odd & 1).tobytes()
    return [packed[(e - n) // 8 : e // 8] for e, n in zip(ends.tolist(), bits.tolist(), strict=True)]


def _differing(x: list[bytes], y: list[bytes]) -> np.ndarray:
    """Bits in which the two maps of each pair differ. A longer map is folded to the other's length."""
    out = np.zeros(len(x), np.int64)
    lengths = np.array([[len(m), len(n)] for m, n in zip(x, y, strict=True)]).reshape(-1, 2)
    for both in np.unique(lengths, axis=0):
        rows, least = np.flatnonzero((lengths == both).all(axis=1)), int(both.min())
        one, two = (
            np.bitwise_xor.reduce(np.frombuffer(b"".join(maps[i] for i in rows), np.uint8).reshape(len(rows), -1, least), axis=1) for maps in (x, y)
        )
        out[rows] = np.bitwise_count(one ^ two).sum(axis=1, dtype=np.int64)
    return out


def _sets_of(nodes: DataFrame, texts: DataFrame, keys: DataFrame) -> DataFrame:
    """(node, size, map, items) of the nodes; keys: one key of each node."""
    wanted = stored(keys.join(nodes, "node", "left_semi").select("key"), "join-wanted")

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", _SLICE):
            sets = _Sets(batch)
            values, at = sets.once()
            some = np.flatnonzero(np.diff(at))
            packed = [packed_sorted(values[at[i] : at[i + 1]]) for i in some.tolist()]
            # Sets left out as empty ones take no values.
            maps = _maps(values, np.append(at[some], at[-1]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(sets.node[some]), pa.array(sets.size[some]), pa.array(maps, pa.binary()), pa.array(packed, pa.binary())],
                names=["node", "size", "map", "items"],
            )

    sets = _beside(texts, wanted, "left_semi").mapInArrow(pick, "node bigint, size bigint, map binary, items binary")
    return stored(sets.dropDuplicates(["node"]), "join-sets")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the stored pairs (a, b) whose sets are similar."""
    def screen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            differing = _differing(batch["x"].to_pylist(), batch["y"].to_pylist())
            # Similar sets of a and b shingles differ in (a + b) / 7 at most.
            keep = 7 * differing <= batch["m"].to_numpy() + batch["n"].to_numpy()
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], names=["a", "b"]).filter(pa.array(keep))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = (None, None)
        for batch in batches:
            keep = []
            for b, x, y in zip(batch["b"].to_pylist(), batch["x"], batch["y"], strict=True):
                if last[0] != b:
                    last = (b, unpacked_sorted(y.as_py()))
                one, two = unpacked_sorted(x.as_py()), last[1]
                common = int((two[np.minimum(np.searchsorted(two, one), len(two) - 1)] == one).sum())
                keep.append(similar(common, len(one), len(two)))
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def held(pairs: DataFrame, check, at_once: int, name: str, **columns: tuple[str, str]) -> DataFrame:
        small = _small(pairs)
        left = sets.select(F.col("node").alias("a"), *[F.col(c).alias(x) for c, (x, _) in columns.items()]).join(small, "a")
        right = sets.select(F.col("node").alias("b"), *[F.col(c).alias(y) for c, (_, y) in columns.items()])
        right = right.join(small.select("b"), "b", "left_semi")
        conf, key = pairs.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
        before = conf.get(key)
        conf.set(key, at_once)
        try:
            return stored(left.join(right, "b").mapInArrow(check, LINK), name)
        finally:
            conf.set(key, before)

    near = held(pairs, screen, _MAPPED, "join-near", size=("m", "n"), map=("x", "y"))
    return held(near, compare, _PAIRS, "join-links", items=("x", "y"))


def _rarest(nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """(shingle, node, size, place, blocks, words): the rarest shingles of nodes (node, size, root), where different groups have them, and
    the place of each in its set, the rarest first; words: a map of the set.

    Sets share at least 3/7 of both sizes together if they are similar, so three quarters of the larger and six sevenths of the smaller
    one. As shingles have one order for all, the first one shared is among the first of either that are not needed for the rest.
    """
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, raw in zip(batch["node"].to_pylist(), batch["items"], strict=True):
                items = unpacked_sorted(raw.as_py()).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(items), node)), pa.array(items)], names=["node", "shingle"])

    each = sets.select("node", "items").mapInArrow(unpack, "node bigint, shingle bigint").join(nodes, "node")
    each = stored(each, "join-each")
    often = each.groupBy("shingle").agg(F.count("*").alias("often"), (F.min("root") < F.max("root")).alias("meets"))
    rarest = Window.partitionBy("node").orderBy("often", "shingle")
    kept = each.join(often, "shingle").withColumn("place", F.row_number().over(rarest)).where(F.col("meets"))
    kept = kept.where(F.col("place") <= _upto("size", 3, 4))
    kept = kept.select("shingle", "node", "size", "place", F.ceil(F.col("often") / _BLOCK).alias("blocks"))

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items = [unpacked_sorted(raw.as_py()) for raw in batch["items"]]
            maps = _maps(np.concatenate([np.empty(0, np.uint64), *items]), np.cumsum([0, *map(len, items)]), 64 * _WORDS, 64 * _WORDS)
            words = np.frombuffer(b"".join(maps), "<i8").reshape(-1, _WORDS)
            yield pa.RecordBatch.from_arrays([batch["node"], *map(pa.array, words.T)], names=["node", *_words("w")])

    words = sets.select("node", "items").mapInArrow(mapped, ", ".join(f"{c} bigint" for c in ["node", *_words("w")]))
    return stored(kept.join(words, "node"), "join-rarest")


def _words(name: str) -> list[str]:
    return [f"{name}{i}" for i in range(_WORDS)]


def _upto(size: str, share: int, of: int):
    """The last place that the first shared shingle may have, where a set shares that part of it at least."""
    return F.col(size) - F.floor((share * F.col(size) + of - 1) / of) + 1


def _in_turn(kept: DataFrame, roots: DataFrame, turn: int) -> DataFrame:
    """(a, b): nodes of different groups that follow one another where the nodes of a shingle, or of a block of it, stand in a random order.

    No more pairs than rows, and a node meets another one at each of its shingles, so few of a cluster stay alone.
    """
    kept = kept.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    order = Window.partitionBy("shingle", F.pmod(F.xxhash64("node"), "blocks")).orderBy(F.xxhash64("shingle", "node", F.lit(turn)), "node")
    met = kept.withColumn("next", F.lead(F.struct("node", "size", "root")).over(order)).where(F.col("root") != F.col("next.root"))
    low, high = F.least("size", "next.size"), F.greatest("size", "next.size")
    return met.where(4 * low >= 3 * high).select(F.least("node", "next.node").alias("a"), F.greatest("node", "next.node").alias("b")).distinct()


def _by_rarest(kept: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes of different groups that their `_rarest` shingles leave as possibly similar."""
    kept = kept.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    # Nodes of a frequent shingle meet block by block; the smaller of two sets goes to each block.
    one = kept.where(F.col("place") <= _upto("size", 6, 7)).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    two = kept.select(
        "shingle", F.pmod(F.xxhash64("node"), "blocks").alias("block"),
        *[F.col(c).alias(f"{c}_b") for c in ("node", "size", "root", "place", *_words("w"))],
    )
    smaller = (F.col("size") < F.col("size_b")) | ((F.col("size") == F.col("size_b")) & (F.col("node") < F.col("node_b")))
    # What follows a shared shingle, and no more than what precedes it in either, may be shared besides.
    after = F.least(F.col("size") - F.col("place"), F.col("size_b") - F.col("place_b"))
    may = 7 * (F.least("place", "place_b") + after) >= 3 * (F.col("size") + F.col("size_b"))
    may &= 7 * sum(F.bit_count(F.col(w).bitwiseXOR(F.col(f"{w}_b"))) for w in _words("w")) <= F.col("size") + F.col("size_b")
    met = one.join(two, ["shingle", "block"]).where((F.col("root") != F.col("root_b")) & smaller & (4 * F.col("size") >= 3 * F.col("size_b")) & may)
    # The last shared place of a pair is the last in both.
    pairs = met.groupBy("node", "node_b", "size", "size_b").agg(F.count("*").alias("n"), F.max("place").alias("place"), F.max("place_b").alias("place_b"))
    return pairs.where(7 * (F.col("n") + after) >= 3 * (F.col("size") + F.col("size_b"))).select(F.col("node").alias("a"), F.col("node_b").alias("b"))


def _to_leaders(members: DataFrame, roots: DataFrame | None) -> DataFrame:
    """(a, b): of each group, one node with one of the group it shares most signatures with among the smallest groups there."""
    rows = members.withColumn("group", F.col("node")) if roots is None else (
        members.join(roots, "node", "left").withColumn("group", F.coalesce("root", "node")).drop("root")
    )
    one = rows.groupBy("sig", "group").agg(F.min(F.struct("node", "size")).alias("n"))
    least = one.groupBy("sig").agg(F.min(F.struct("group", "n")).alias("l"))
    least = stored(least, "join-least")
    met = one.join(least, "sig").where(F.col("group") != F.col("l.group"))
    low, high = F.least("n.size", "l.n.size"), F.greatest("n.size", "l.n.size")
    pairs = met.where(4 * low >= 3 * high).groupBy("group", F.col("l.n.node").alias("a"), F.col("n.node").alias("b")).count()
    return pairs.groupBy("group").agg(F.max_by(F.struct("a", "b"), F.struct("count", "a", "b")).alias("p")).select("p.a", "p.b")


def linked_texts(documents: DataFrame, *, crowd: int = CROWD) -> tuple[DataFrame, DataFrame]:
    """(key, node, size) of each distinct text and (node, root) of each node with links.

    key is the MD5 of the text, node a 64-bit name of its set of shingles. A set: the distinct runs of `K` words; with fewer words,
    the whole sequence as one; NULL or no words: empty, without links. Sets are linked at a Jaccard similarity of 3/4 or more; root is the
    smallest node that links reach. No link is missed and none is made up. Only doc_id and text are read; ``crowd`` chooses
    the way and changes no result.
    """
    texts = documents.select(F.coalesce("text", F.lit("")).alias("text")).withColumn("key", text_key(F.col("text")))
    n = documents.count()
    bits, mask = _bits(n), _mask(n)
    schema = "a bigint, b bigint, times bigint, need bigint"
    sent = stored(_sent(texts, max(0, bits - 4), mask, first=FIRST), "join-first")
    told = stored(_reported(sent, "key binary, node bigint, size bigint, left bigint"), "join-told")
    keys = stored(told.select("key", "node", "size").distinct(), "join-keys")
    one_key = stored(keys.groupBy("node").agg(F.min("key").alias("key")), "join-one-key")

    def owned(rows: DataFrame, match, out: str) -> DataFrame:
        return rows.where(F.col("kind") == 1).groupBy("owner").applyInArrow(match, out)

    members = stored(owned(sent, _members, "sig bigint, node bigint, size bigint"), "join-members")
    sets = _sets_of(members.select("node").distinct(), texts, one_key)

    def joined(roots: DataFrame | None, found: DataFrame) -> DataFrame:
        if roots is not None:
            if found.isEmpty():
                return roots
            found = found.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b")))
        return stored(components(found), "join-roots")

    roots = None
    for _ in range(ROUNDS):
        pairs = stored(_to_leaders(members, roots), "join-pairs")
        roots = joined(roots, _verified(pairs, sets))

    def grouped(of: DataFrame, how: str = "left") -> DataFrame:
        return _beside(texts, stored(keys.join(of, "node").select("key", "root"), "join-groups"), how)

    def across(most: int):
        return lambda table: _across(table, most)

    def crowded(found: DataFrame) -> DataFrame:
        return found.where(F.col("b").isNull()).groupBy("a").agg(F.sum("times").alias("crowded"))

    def more(found: DataFrame, roots: DataFrame) -> DataFrame:
        pairs = found.where(F.col("b").isNotNull()).groupBy("a", "b").agg(F.sum("times").alias("times"), F.max("need").alias("need"))
        # What crowded signatures may hide of a pair counts as shared, twice where one may stand for two.
        hidden = crowded(found)
        pairs = pairs.join(hidden, "a", "left").join(hidden.select(F.col("a").alias("b"), F.col("crowded").alias("too")), "b", "left")
        hides = 2 * F.least(F.coalesce("crowded", F.lit(0)), F.coalesce("too", F.lit(0)))
        pairs = stored(pairs.where(F.col("times") + hides >= F.col("need")).select("a", "b"), "join-pairs")
        if pairs.isEmpty():
            return roots
        both = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
        return joined(roots, _verified(pairs, _sets_of(both, texts, one_key)))

    found = stored(owned(_sent(grouped(roots), bits, mask, report=False), across(crowd), schema), "join-found")
    roots = more(found, roots)
    # A crowded signature costs up to two; all of a node's are charged to its band with the least slack, which errs to the safe side.
    least = told.groupBy("node").agg(F.min("left").alias("left"))
    short = least.join(crowded(found), least["node"] == F.col("a"), "left").where(F.col("left") < 2 * F.coalesce("crowded", F.lit(0))).select("node")
    short = stored(short, "join-short")
    if short.isEmpty():
        return keys, roots
    mine = short.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"))
    sent = _sent(grouped(mine, "inner"), max(0, bits - 4), mask, single=True, report=False)
    found = stored(owned(sent, across(crowd), schema), "join-found")
    roots = more(found, roots)
    sizes = keys.groupBy("node").agg(F.max("size").alias("size"))
    # Similar sets share three quarters of either; if no more than all but one of these are crowded or not sent, another is not.
    spare = F.floor((3 * F.col("size") + 3) / 4) - 1
    spare = spare - F.floor(spare / 2)
    short = crowded(found).join(sizes, F.col("a") == F.col("node")).where(F.col("crowded") > spare)
    short = stored(short.join(roots, "node", "left").select("node", "size", F.coalesce("root", "node").alias("root")), "join-short")
    if short.isEmpty():
        return keys, roots
    sets = _sets_of(short.select("node"), texts, one_key)
    rarest = _rarest(short, sets)
    for turn in range(ROUNDS):
        pairs = stored(_in_turn(rarest, roots, turn), "join-pairs")
        roots = joined(roots, _verified(pairs, sets))
    pairs = stored(_by_rarest(rarest, roots), "join-pairs")
    return keys, joined(roots, _verified(pairs, sets))


def component_of(documents: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest doc_id that links reach, its own included).

    Rows with equal texts or sets of shingles are linked; NULL doc_ids are never the smallest, so a component of these alone
    has NULL. A document without shingles has its own doc_id. Repeated rows stay; an empty table gives an empty result.
    """
    keys, roots = linked_texts(documents, **options)
    named = stored(keys.join(roots, "node", "left").select("key", F.coalesce("root", "node").alias("root"), "size"), "join-named")
    rows = documents.select("doc_id", text_key(F.col("text")).alias("key")).join(named, "key")
    rows = stored(rows.select("doc_id", "root", "size"), "join-rows")
    least = stored(rows.where(F.col("size") > 0).groupBy("root").agg(F.min("doc_id").alias("component_id")), "join-least")
    full = rows.where(F.col("size") > 0).join(least, "root").select("doc_id", F.col("size").alias("n_shingles"), "component_id")
    bare = rows.where(F.col("size") == 0).select("doc_id", F.col("size").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return full.unionByName(bare)


def one_of_each(documents: DataFrame, **options) -> DataFrame:
    """The documents with one of each component, the one with the smallest doc_id (NULL last, then by text); all their columns.

    Documents without shingles are linked with nothing and all stay.
    """
    keys, roots = linked_texts(documents, **options)
    named = stored(
        keys.where(F.col("size") > 0).join(roots, "node", "left").select(F.col("key").alias("__key"), F.coalesce("root", "node").alias("__root")),
        "join-named",
    )
    keyed = documents.withColumn("__key", text_key(F.col("text"))).join(named, "__key", "left")
    first = Window.partitionBy("__root").orderBy(F.col("doc_id").asc_nulls_last(), "__key")
    best = keyed.where(F.col("__root").isNotNull()).withColumn("__rank", F.row_number().over(first)).where(F.col("__rank") == 1)
    return best.drop("__rank").unionByName(keyed.where(F.col("__root").isNull())).select(*[F.col(f"`{c}`") for c in documents.columns])
