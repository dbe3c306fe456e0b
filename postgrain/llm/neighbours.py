"""Approximate nearest neighbours by cosine: NN-descent builds a graph, queries walk it greedily.

Equal vectors are one node of the graph, known by their smallest ids, so a vector that fills a third of the table costs
no more than any other. The first graph comes from random trees: vectors sorted by the sides they take of a few random
planes, and compared within runs of `LEAF`. Each round of NN-descent joins every node's neighbours and reverse neighbours with each other, as the
nodes that have a neighbour in common, and keeps the nearest `degree` found. A query starts at its own node and expands the best `beam` nodes it knows, along links and against them, until `hops` are done.

While the graph is built and walked, components travel in single precision and are multiplied in double, so that near-equal vectors keep their order; all that a
walk ends with is scored again, by cosines of the original vectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from postgrain.llm.store import stored

DEGREE = 40
TREES = 6
LEAF = 256
ROUNDS = 3
BEAM = 112
HOPS = 5
SEED = 20


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """id, vec (array of doubles) of rows that take part, repeated rows once.

    NULL, empty and zero vectors and those with a NULL or non-finite component do not; neither do vectors of another
    length than most, which no cosine compares.
    """
    vec = F.col(vector).cast("array<double>")
    fine = ~F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("vec", lambda x: x != 0)
    rows = vectors.select(F.col(key).alias("id"), vec.alias("vec")).where(fine).distinct()
    lengths = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1)
    return rows.join(F.broadcast(lengths.select("n")), F.size("vec") == F.col("n")).drop("n")


def _unit(batch: pa.Array) -> np.ndarray:
    flat = batch.flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1) if len(batch) else np.empty((0, 0))
    # Largest component first, so that squares neither overflow nor vanish.
    flat = flat / np.abs(flat).max(axis=1, keepdims=True) if len(flat) else flat
    return flat / np.linalg.norm(flat, axis=1, keepdims=True) if len(flat) else flat


def _floats(column: pa.Array) -> np.ndarray:
    """Unit vectors as they travel."""
    return np.frombuffer(b"".join(column.to_pylist()), np.float32).reshape(len(column), -1).astype(np.float64)


def _rows(unit: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in unit.astype(np.float32)], pa.binary())


def _planted(nodes: DataFrame, trees: int, leaf: int, seed: int) -> DataFrame:
    """tree, side, along, id, unit: each node in each tree, by the sides it takes and how far it lies along one more direction."""
    depth = max(1, math.ceil(math.log2(max(2, nodes.count() / leaf)))) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unit = _floats(batch["unit"])
            if not len(unit):
                continue
            planes = np.random.default_rng(seed).standard_normal((trees, unit.shape[1], min(depth, 62) + 1))
            for tree in range(trees):
                at = unit @ planes[tree]
                side = ((at[:, :-1] > 0) @ (1 << np.arange(at.shape[1] - 1, dtype=np.int64))).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(unit), tree)), pa.array(side), pa.array(at[:, -1]), batch["id"], batch["unit"]],
                    names=["tree", "side", "along", "id", "unit"],
                )

    return nodes.select("id", "unit").mapInArrow(run, "tree bigint, side bigint, along double, id bigint, unit binary")


def _best(ids: np.ndarray, unit: np.ndarray, degree: int, worst: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(node, neighbour, score) of the nearest ``degree`` of each within a group, where better than its ``worst``."""
    score = unit @ unit.T
    np.fill_diagonal(score, -np.inf)
    if len(ids) > degree + 1:
        top = np.argpartition(-score, degree - 1, axis=1)[:, :degree]
    else:
        top = np.argsort(-score, axis=1)[:, : len(ids) - 1]
    got = np.take_along_axis(score, top, axis=1)
    keep = np.isfinite(got) & (got > worst[:, None] if worst is not None else True)
    row = np.repeat(np.arange(len(ids)), keep.sum(axis=1))
    return ids[row], ids[top[keep]], got[keep]


EDGE = "id bigint, other bigint, score double"


def _edges(found: list[tuple]) -> pa.RecordBatch:
    a, b, s = (np.concatenate(x) for x in zip(*found, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(s)], names=["id", "other", "score"])


def _in_leaves(planted: DataFrame, leaf: int, degree: int) -> DataFrame:
    """Neighbours within runs of ``leaf`` rows in the order of the trees; a task holds a run."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0

        def settle() -> pa.RecordBatch | None:
            table = pa.Table.from_batches(held).combine_chunks()
            found, tree = [], table["tree"].to_numpy()
            ids, unit = table["id"].to_numpy(), _floats(table["unit"].combine_chunks())
            for a in range(0, len(ids), leaf):
                for t in np.unique(tree[a : a + leaf]):
                    own = np.flatnonzero(tree[a : a + leaf] == t) + a
                    if len(own) > 1:
                        found.append(_best(ids[own], unit[own], degree))
            return _edges(found) if found else None

        for batch in batches:
            while batch.num_rows:
                take = min(batch.num_rows, 16 * leaf - rows)
                held.append(batch.slice(0, take))
                batch, rows = batch.slice(take), rows + take
                if rows == 16 * leaf:
                    if (out := settle()) is not None:
                        yield out
                    held, rows = [], 0
        if held and (out := settle()) is not None:
            yield out

    order = ["tree", "side", "along", "id"]
    return planted.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, EDGE)


def _nearest(edges: DataFrame, degree: int) -> DataFrame:
    best = Window.partitionBy("id").orderBy(F.desc("score"), "other")
    once = edges.groupBy("id", "other").agg(F.max("score").alias("score"))
    return once.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= degree).drop("rank")


def _descend(graph: DataFrame, nodes: DataFrame, degree: int) -> DataFrame:
    """Edges between nodes that share a neighbour, where better than the worst a node has.

    A node meets its neighbours and the nodes that have it as one; of the latter the nearest ``degree``, so no hub gathers more.
    """
    inward = Window.partitionBy("other").orderBy(F.desc("score"), "id")
    kept = graph.withColumn("rank", F.row_number().over(inward)).where(F.col("rank") <= degree)
    meets = kept.select(F.col("id").alias("centre"), F.col("other").alias("id")).unionByName(
        kept.select(F.col("other").alias("centre"), "id")
    ).distinct()
    worst = graph.groupBy("id").agg(F.when(F.count("*") >= degree, F.min("score")).otherwise(-2.0).alias("worst"))
    carried = nodes.select("id", "unit").join(worst, "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = None
        for batch in batches:
            table = pa.Table.from_batches([left, batch] if left is not None else [batch]).combine_chunks()
            centre = table["centre"].to_numpy()
            edges = np.flatnonzero(np.diff(centre)) + 1
            whole = int(edges[-1]) if len(edges) else 0
            left = table.slice(whole).combine_chunks().to_batches()[0]
            if whole:
                yield from pairs(table.slice(0, whole), edges)
        if left is not None and left.num_rows:
            yield from pairs(pa.Table.from_batches([left]), np.array([left.num_rows]))

    def pairs(table: pa.Table, edges: np.ndarray) -> Iterator[pa.RecordBatch]:
        table = table.combine_chunks()
        ids, worst_of = table["id"].to_numpy(), table["worst"].to_numpy()
        unit, found, a = _floats(table["unit"].combine_chunks()), [], 0
        for b in edges.tolist():
            if b - a > 1:
                found.append(_best(ids[a:b], unit[a:b], degree, worst_of[a:b]))
            a = b
        if found:
            yield _edges(found)

    return meets.join(carried, "id").repartition("centre").sortWithinPartitions("centre").mapInArrow(run, EDGE)


def build_graph(
    nodes: DataFrame, *, degree: int = DEGREE, trees: int = TREES, leaf: int = LEAF, rounds: int = ROUNDS, seed: int = SEED
) -> DataFrame:
    """id, other, score: up to ``degree`` near nodes of each node (id, unit as bytes)."""
    graph = stored(_nearest(_in_leaves(_planted(nodes, trees, leaf, seed), leaf, degree), degree), "graph")
    for _ in range(rounds):
        graph = stored(_nearest(graph.unionByName(_descend(graph, nodes, degree)), degree), "graph")
    return graph


def _scored(pairs: DataFrame, nodes: DataFrame, queries: DataFrame) -> DataFrame:
    """query, id, score for pairs (query, id)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                score = np.einsum("ij,ij->i", _floats(batch["unit"]), _floats(batch["asked"]))
                yield pa.RecordBatch.from_arrays([batch["query"], batch["id"], pa.array(score)], names=["query", "id", "score"])

    asked = queries.select(F.col("id").alias("query"), F.col("unit").alias("asked"))
    return pairs.join(nodes.select("id", "unit"), "id").join(asked, "query").mapInArrow(run, "query bigint, id bigint, score double")


def search_graph(graph: DataFrame, nodes: DataFrame, queries: DataFrame, *, beam: int = BEAM, hops: int = HOPS, degree: int = DEGREE) -> DataFrame:
    """query, id, score: the ``beam`` best nodes that a greedy walk from each query's own node finds (queries: nodes, a part of them)."""
    best = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    inward = Window.partitionBy("other").orderBy(F.desc("score"), "id")
    back = graph.withColumn("rank", F.row_number().over(inward)).where(F.col("rank") <= degree)
    links = graph.select("id", "other").unionByName(back.select(F.col("other").alias("id"), F.col("id").alias("other")))
    links = stored(links.distinct(), "links")
    own = queries.select(F.col("id").alias("query"), "id", F.lit(1.0).alias("score"))
    known, scored = stored(own.withColumn("spent", F.lit(False)), "beam"), own
    for _ in range(hops):
        ahead = known.where(~F.col("spent")).join(links, "id").select("query", F.col("other").alias("id")).distinct()
        fresh = stored(_scored(ahead.join(scored, ["query", "id"], "left_anti"), nodes, queries), "scored")
        scored = scored.unionByName(fresh)
        seen = known.withColumn("spent", F.lit(True)).unionByName(fresh.withColumn("spent", F.lit(False)))
        known = stored(seen.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= beam).drop("rank"), "beam")
    return known.select("query", "id", "score")


def nearest(vectors: DataFrame, is_query, *, key: str = "vec_id", vector: str = "embedding", k: int = 5, **options) -> DataFrame:
    """The ``k`` nearest rows found of each query row: query_id, rank, vec_id, score, nearest first, ties to the smaller id.

    ``is_query`` is a condition on a column ``id``. Every usable row (see `usable`) is in the index and a candidate of every query
    but itself; repeated rows count once. Fewer candidates give fewer rows, an empty table none. Other columns are ignored.
    """
    rows = stored(usable(vectors, key, vector), "vectors")
    smallest = Window.partitionBy("vec").orderBy("id")
    # A query may be among the smallest ids of its own vector, hence one more than k.
    some = rows.withColumn("place", F.row_number().over(smallest)).where(F.col("place") <= k + 1)
    members = some.groupBy("vec").agg(F.min("id").alias("node"), F.sort_array(F.collect_list("id")).alias("ids"))

    def units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch["node"], batch["vec"], batch["ids"], _rows(_unit(batch["vec"]))], names=["id", "vec", "ids", "unit"])

    nodes = stored(members.select("node", "vec", "ids").mapInArrow(units, "id bigint, vec array<double>, ids array<bigint>, unit binary"), "nodes")
    asking = rows.where(is_query).join(nodes.select(F.col("id").alias("node"), "vec"), "vec").select(F.col("id").alias("query_id"), "node", "vec")
    asking = stored(asking, "asking")
    graph_options = {n: options[n] for n in ("degree", "trees", "leaf", "rounds", "seed") if n in options}
    walk_options = {n: options[n] for n in ("beam", "hops", "degree") if n in options}
    graph = build_graph(nodes, **graph_options)
    starts = nodes.join(asking.select(F.col("node").alias("id")).distinct(), "id", "left_semi")
    found = search_graph(graph, nodes, starts, **walk_options)
    return _exact(found, nodes, asking, k)


def _exact(found: DataFrame, nodes: DataFrame, asking: DataFrame, k: int) -> DataFrame:
    """The nodes found as rows, scored anew on the original vectors."""
    pairs = (
        found.select(F.col("query").alias("node"), F.col("id").alias("near")).join(asking, "node")
        .join(nodes.select(F.col("id").alias("near"), F.col("vec").alias("other"), "ids"), "near")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (_unit(batch[n]) for n in ("vec", "other"))
                same = np.array([x == y for x, y in zip(batch["near"].to_pylist(), batch["node"].to_pylist(), strict=True)])
                score = np.where(same, 1.0, np.einsum("ij,ij->i", a, b))
                yield pa.RecordBatch.from_arrays([batch["query_id"], batch["ids"], pa.array(score)], names=["query_id", "ids", "score"])

    each = pairs.mapInArrow(run, "query_id bigint, ids array<bigint>, score double").select("query_id", F.explode("ids").alias("vec_id"), "score")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        each.where(F.col("query_id") != F.col("vec_id")).withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
