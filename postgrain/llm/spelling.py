"""Spelling variants: pairs of words one edit apart, by composing word acceptors with a one-edit transducer.

Words of one length make an acceptor; states with the same right language are one. A pair of words is a path through (acceptor
of the shorter word) o (one edit) o (acceptor of the other), whose states are pairs of acceptor states: equal ones up to the edit,
which comes at the end of the common prefix, then any pair that has symbols in common. States from which nothing is accepted are taken
away before paths are listed, so listing costs what it finds.

The machine is cut at its first states: the words of a length L, and those of L + 1, are dealt by a range of edit places, [0, L/2) or
[L/2, L], and by what a pair with such an edit has in common: all before the range and all after it. A cell with too many words is
cut again at the middle of its range, down to single places, where the alphabet bounds it. Cells with one word end there. No cell is ever
compared word by word.

Words come from whole texts, longest ones too; a very long word costs time in proportion to its length. A null text has no words, a null
doc_id counts as the empty string, repeated rows count again, an empty table gives no words, other columns are ignored. Ties go to
the smaller word by code points.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postgrain.llm.store import stored
from postgrain.llm.text import mixed

LEAST_LENGTH = 5
LEAST_COUNT = 3
# One edit in so many keys of a document's words is planted, as the query asks.
PLANTED = 97
# Words that one cell may hold before it is cut, words that a task gets at once, counts that a task gathers before it passes them on.
CELL_WORDS = 10_000
TASK_WORDS = 20_000
FLUSH = 1 << 19
PIECE = 1 << 20

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_BREAK = re.compile(r"[^A-Za-zÀ-ÿ]")


def runs(text: str, pattern: re.Pattern) -> Counter:
    """How often each match occurs, cut between runs so that a long text is not a list of all its runs at once."""
    counts, at = Counter(), 0
    while at < len(text):
        cut = _BREAK.search(text, at + PIECE)
        end = cut.start() if cut else len(text)
        counts.update(pattern.findall(text, at, end))
        at = end
    return counts


def count_words(documents: DataFrame, planted: int = PLANTED, least_length: int = LEAST_LENGTH) -> DataFrame:
    """word, n: letters in a row, A-Z in lower case, at least ``least_length`` of them. Where ``planted`` divides the CRC-32 h of ``doc_id:word``,
    the letter at h modulo the length is left out of that document's word; 0 leaves all as they are."""
    pattern = re.compile(r"[A-Za-zÀ-ÿ]{%d,}" % least_length)

    def rows(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counter()
        for batch in batches:
            texts = batch["text"].cast(pa.large_binary())
            for doc_id, text in zip(batch["doc_id"].to_pylist(), texts, strict=True):
                start = crc32(f"{doc_id}:".encode())
                for word, n in runs(text.as_buffer().to_pybytes().translate(_LOWER).decode(), pattern).items():
                    if planted:
                        h = crc32(word.encode(), start)
                        if h % planted == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                            if len(word) < least_length:
                                continue
                    counts[word] += n
                if len(counts) > FLUSH:
                    yield rows(counts)
                    counts = Counter()
        if counts:
            yield rows(counts)

    columns = [F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")]
    return documents.select(*columns).mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


class Acceptor:
    """The words of one length, rows of a byte matrix in order. A node is a distinct prefix; ``first[d][i]`` is the first child of node i of
    depth d, among the nodes of depth d + 1 in order of (parent, symbol); ``arcs[d + 1]`` holds parent * 256 + symbol of each of these;
    ``language[d]`` names what may follow each node, equal names being one state of the minimised acceptor."""

    def __init__(self, words: np.ndarray):
        n, length = words.shape
        differs = words[1:] != words[:-1]
        common = differs.argmax(axis=1) if length else np.zeros(max(n - 1, 0), np.int64)
        self.length, self.first, self.arcs, self.language = length, [None] * length, [None] * (length + 1), [None] * (length + 1)
        self.language[length] = np.ones(n, np.uint64)
        below = np.arange(n)
        for d in range(length - 1, -1, -1):
            starts = np.flatnonzero(np.append(True, common < d))
            self.first[d] = np.append(np.searchsorted(below, starts), len(below))
            symbol = words[below, d].astype(np.int64)
            self.arcs[d + 1] = np.repeat(np.arange(len(starts)), np.diff(self.first[d])) * 256 + symbol
            arc = mixed(self.language[d + 1] * np.uint64(0x9E3779B97F4A7C15) + symbol.astype(np.uint64))
            self.language[d] = mixed(np.add.reduceat(arc, self.first[d][:-1]))
            below = starts

    def children(self, d: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position in ``nodes``, child) for every child of every node."""
        size = self.first[d][nodes + 1] - self.first[d][nodes]
        return np.repeat(np.arange(len(nodes)), size), _counted(self.first[d][nodes], size)

    def siblings(self, d: int) -> tuple[np.ndarray, np.ndarray]:
        """All pairs of children of one node, for all nodes of a depth. A node has at most as many children as the alphabet has symbols."""
        child = np.arange(len(self.arcs[d + 1]))
        size = np.repeat(self.first[d][1:], np.diff(self.first[d])) - child - 1
        return np.repeat(child, size), _counted(child + 1, size)


def _counted(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start, start + 1, ... ``size`` times, one after the other."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())


Pairs = tuple[np.ndarray, np.ndarray]
_NONE: Pairs = (np.empty(0, np.int64), np.empty(0, np.int64))


def _joined(*pairs: Pairs) -> Pairs:
    return np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])


class Composition:
    """Acceptor a o one edit o acceptor b. Behind the edit a node of a goes with a node of b that is ``shift`` deeper."""

    def __init__(self, a: Acceptor, b: Acceptor, shift: int):
        self.a, self.b, self.shift = a, b, shift
        both = [np.concatenate([a.language[d], b.language[d + shift]]) for d in range(a.length + 1)]
        self.state = [np.unique(x, return_inverse=True)[1] for x in both]

    def states(self, d: int, pairs: Pairs) -> np.ndarray:
        """The pair of states that each pair of nodes is in, as one number."""
        state, n = self.state[d], len(self.a.language[d])
        return state[pairs[0]] * len(state) + state[n + pairs[1]]

    def step(self, d: int, pairs: Pairs, shift: int, barred: np.ndarray | None = None) -> tuple[np.ndarray, Pairs]:
        """(position, children) wherever both nodes of a pair have an arc of one symbol, other than the pair's ``barred`` one."""
        at, left = self.a.children(d, pairs[0])
        symbol = self.a.arcs[d + 1][left] % 256
        arcs, wanted = self.b.arcs[d + 1 + shift], pairs[1][at] * 256 + symbol
        right = np.searchsorted(arcs, wanted)
        ok = arcs[np.minimum(right, len(arcs) - 1)] == wanted
        if barred is not None:
            ok &= symbol != barred[at]
        return at[ok], (left[ok], right[ok])

    def replaced(self, places: range) -> dict[int, Pairs]:
        """Pairs behind a replaced symbol, by depth. Here a is b, and each pair of words comes once."""
        return {d + 1: self.a.siblings(d) for d in places}

    def inserted(self, places: range) -> dict[int, Pairs]:
        """Pairs behind a symbol that b alone has. It isn't the next one of a, so it stands at the end of the common prefix."""
        out: dict[int, Pairs] = {}
        pairs: Pairs = (np.zeros(1, np.int64), np.zeros(1, np.int64))
        for d in range(places.stop):
            if d in places:
                at, more = self.b.children(d, pairs[1])
                edited = (pairs[0][at], more)
                if d < self.a.length:
                    out[d + 1] = _joined(out.get(d + 1, _NONE), self.step(d, edited, 1, self.b.arcs[d + 1][more] % 256)[1])
                else:
                    out[d] = _joined(out.get(d, _NONE), edited)
            if d < self.a.length:
                pairs = self.step(d, pairs, 0)[1]
        return out

    def paths(self, edits: dict[int, Pairs]) -> Pairs:
        """(word of a, word of b) of every accepted path, given the pairs of nodes behind the edits."""
        length = self.a.length
        known, arcs, front = [], [], _NONE
        for d in range(length + 1):  # all pairs of states that can be reached, each once
            front = _joined(front, edits.get(d, _NONE))
            number, place = np.unique(self.states(d, front), return_index=True)
            front = (front[0][place], front[1][place])
            known.append(number)
            if d < length:
                at, front = self.step(d, front, self.shift)
                arcs.append((at, self.states(d + 1, front)))
        alive = [known[length]]
        for d in range(length - 1, -1, -1):  # those from which the end can be reached
            at, to = arcs[d]
            alive.append(known[d][np.unique(at[np.isin(to, alive[-1])])])
        alive.reverse()
        front = _NONE
        for d in range(length + 1):  # all paths through these
            front = _joined(front, edits.get(d, _NONE))
            keep = np.isin(self.states(d, front), alive[d])
            front = (front[0][keep], front[1][keep])
            if d < length:
                front = self.step(d, front, self.shift)[1]
        return front


_CELL_BYTES = 3


def _acceptor(words: list[str], cells: np.ndarray) -> tuple[Acceptor, np.ndarray]:
    """The acceptor of words of one length, each behind the number of its cell, and the order in which it numbers them."""
    letters = np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)
    digits = np.stack([(cells >> s & 255).astype(np.uint8) for s in (16, 8, 0)], axis=1)
    matrix = np.ascontiguousarray(np.concatenate([digits, letters], axis=1))
    order = np.argsort(matrix.view(f"S{matrix.shape[1]}").reshape(-1), kind="stable")
    return Acceptor(matrix[order]), order


def near_pairs(words: list[str], cells: np.ndarray, shorter: int, lo: int, top: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the words of a cell that differ by one edit at a place in [lo, top), for all cells: each pair once.

    Words have the length ``shorter`` or one more; those of a cell share all before ``lo`` and as many at their ends as a word of length ``shorter`` has from ``top`` on.
    """
    tail = max(0, shorter - top)
    free = [w[lo : len(w) - tail] for w in words]
    size = np.array([len(w) for w in words])
    short, long = np.flatnonzero(size == shorter), np.flatnonzero(size == shorter + 1)
    if not len(short):
        return _NONE
    a, order = _acceptor([free[i] for i in short], cells[short])
    short = short[order]
    places = range(_CELL_BYTES, _CELL_BYTES + top - lo)
    same = Composition(a, a, 0)
    i, j = same.paths(same.replaced(range(_CELL_BYTES, min(places.stop, a.length))))
    found = [(short[i], short[j])]
    if len(long):
        b, order = _acceptor([free[i] for i in long], cells[long])
        long = long[order]
        longer = Composition(a, b, 1)
        i, j = longer.paths(longer.inserted(places))
        found.append((short[i], long[j]))
    i, j = _joined(*found)
    # Cells are told apart by hashes; what their words share is looked at here.
    ok = np.array([
        words[x][:lo] == words[y][:lo] and words[x][len(words[x]) - tail :] == words[y][len(words[y]) - tail :]
        for x, y in zip(i.tolist(), j.tolist(), strict=True)
    ], bool)
    return i[ok], j[ok]


def _compose(table: pa.Table) -> pa.Table:
    """Both directions of all near pairs of a task's cells."""
    shape = [table[c][0].as_py() for c in ("shorter", "lo", "top")]
    words, n = table["word"].to_pylist(), table["n"].to_numpy()
    cells = np.unique(table["cell"].to_numpy(), return_inverse=True)[1]
    i, j = near_pairs(words, cells, *shape)
    a, b = np.concatenate([i, j]), np.concatenate([j, i])
    word = table["word"].combine_chunks()
    return pa.table({"word": word.take(pa.array(a)), "near": word.take(pa.array(b)), "near_n": pa.array(n[b])})


def _cut(rows: DataFrame, ranges: list) -> DataFrame:
    """The rows with each (lo, top) of ``ranges``, and the cell that they are in then."""
    cut = rows.select("word", "n", "shorter", F.explode(F.array(*[F.struct(lo.alias("lo"), top.alias("top")) for lo, top in ranges])).alias("range"))
    shared = "xxhash64(left(word, lo), right(word, greatest(0, shorter - top)))"
    return cut.select("word", "n", "shorter", "range.*").withColumn("cell", F.expr(shared))


def near_words(words: DataFrame, cell_words: int = CELL_WORDS, task_words: int = TASK_WORDS) -> DataFrame:
    """word, near, near_n: both directions of all pairs of (word, n) that differ by one inserted, deleted or replaced code point."""
    letters = F.length("word")
    roles = words.select("word", "n", F.explode(F.array(letters, letters - 1)).alias("shorter"))
    least = words.select(F.min(letters))
    roles = roles.where(F.col("shorter") >= least.scalar())
    middle = F.floor((F.col("shorter") + 1) / 2).cast("int")
    state = _cut(roles, [(F.lit(0), middle), (middle, F.col("shorter") + 1)])
    cell, shape, ready, sizes_of = ["shorter", "lo", "top", "cell"], ["shorter", "lo", "top"], None, None
    while True:
        state = stored(state, "roles")
        sizes = state.groupBy(*cell).agg(F.count("*").alias("size"), F.count_if(F.length("word") == F.col("shorter")).alias("shorts"))
        sizes = stored(sizes.where((F.col("size") > 1) & (F.col("shorts") > 0)).drop("shorts"), "cells")
        large = (F.col("size") > cell_words) & (F.col("top") - F.col("lo") > 1)
        done = state.join(sizes.where(~large).select(*cell), cell, "left_semi")
        ready = done if ready is None else ready.unionByName(done)
        kept = sizes.where(~large).groupBy(*shape).agg(F.sum("size").alias("size"))
        sizes_of = kept if sizes_of is None else sizes_of.unionByName(kept)
        large = sizes.where(large)
        if large.isEmpty():
            break
        middle = F.floor((F.col("lo") + F.col("top")) / 2).cast("int")
        state = _cut(state.join(large.select(*cell), cell, "left_semi"), [(F.col("lo"), middle), (middle, F.col("top"))])
    buckets = sizes_of.groupBy(*shape).agg(F.ceil(F.sum("size") / task_words).alias("buckets"))
    dealt = ready.join(buckets, shape).withColumn("bucket", F.pmod("cell", "buckets"))
    return dealt.groupBy(*shape, "bucket").applyInArrow(_compose, "word string, near string, near_n bigint")


def roots(links: DataFrame) -> DataFrame:
    """word, root for every (word, form): the last form that forms lead to. Counts double at least from form to form, so paths are short."""
    links = stored(links.select("word", F.col("form").alias("root")), "forms")
    while True:
        on = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if links.join(on, "root", "left_semi").isEmpty():
            return links
        links = stored(links.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "forms")


def group_variants(documents: DataFrame, *, planted: int = 0, least_count: int = LEAST_COUNT, **options) -> DataFrame:
    """word, form, root, n, n_near, form_n for each word of at least ``least_count`` occurrences.

    ``form``: the near word that occurs most, if at least twice as often as the word; ``root``: where forms lead to. ``planted``: see `count_words`.
    """
    words = stored(count_words(documents, planted).where(F.col("n") >= least_count), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("form")))
    near = near_words(words, **options).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    followed = F.coalesce(-F.col("best.minus") >= 2 * F.col("n"), F.lit(False))
    found = stored(words.join(near, "word", "left").select(
        "word", F.when(followed, F.col("best.form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(followed, -F.col("best.minus")).alias("form_n"),
    ), "variants")
    ends = roots(found.where(F.col("form").isNotNull()))
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
