"""Exact top-k by inner product of whole-number vectors, by best-first search of M-trees.

With one more component, the root of (largest squared norm - its own), all vectors lie on a sphere, and the larger an inner product with a
query, the nearer that point is to the query's. So inner products are searched for in a metric space, by M-trees.

The root page has up to `PIVOTS` routing objects, drawn from a bounded sample, with covering radii; every vector goes to its nearest one.
The vectors of one routing object are dealt to parts of about `PART`, and each part is an M-tree of its own, bulk-loaded and
stored as rows: pages of up to `PAGE` entries, each with a routing object, its covering radius and its distance to the parent's. A query first
searches the part that it lies in, then the parts of the nearest cells, then all others that can still hold a better answer. In a
part it takes the page with the least possible distance first; |d(query, parent) - d(entry, parent)| - radius, which is stored but for the first
term, rules entries out before their distance is computed. Bounds are kept loose by `SLACK` for rounding; scores are exact.

Equal vectors are one entry with their k + 1 smallest ids, as no query can return more, so a vector that fills a third of the table costs no more than
any other; near-equal ones share a cell of many parts. Rows without id, without vector or with a null or non-finite component take
no part. Repeated rows count once. Vectors of different lengths are compared as if the shorter ones ended in zeros. An empty table gives no rows,
other columns are ignored, ties go to the smaller id. Scores beyond the range of a long count as its
largest or smallest value. Of rows with one id and several vectors each is a query and a candidate by itself.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from postgrain.llm.store import stored

SCALE = 256
PIVOTS = 1024
PART = 8192
PAGE = 256
# Queries that a task searches a part for.
VISITS = 4096
# Cells that a query visits together, nearest first, before it asks which of all others remain.
NEAREST_CELLS = 8
# Part of the sphere's radius by which a bound may be wrong through rounding.
SLACK = 1e-6
_LONG = (-(1 << 63), (1 << 63) - 1)


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """id, codes (whole numbers) of the rows that take part, repeated rows once."""
    rows = vectors.select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("vec"))
    fine = F.col("id").isNotNull() & ~F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(fine).select("id", F.transform("vec", lambda x: F.floor(x * SCALE)).alias("codes")).distinct()


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of whole numbers as doubles, filled up with zeros."""
    out = np.zeros((len(column), dims))
    size = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64) if len(column) else np.empty(0, np.int64)
    at = np.repeat(np.arange(len(size)) * dims - (np.cumsum(size) - size), size) + np.arange(size.sum())
    out.reshape(-1)[at] = column.flatten().to_numpy(zero_copy_only=False)
    return out


@dataclass(frozen=True)
class Space:
    """What all tasks know: components of a vector, the sphere's squared radius, and the root page."""

    dims: int
    bound: float
    pivots: np.ndarray
    radius: np.ndarray | None = None
    parts: np.ndarray | None = None

    def lifted(self, x: np.ndarray) -> np.ndarray:
        """The vectors on the sphere."""
        more = np.sqrt(np.maximum(self.bound - np.einsum("ij,ij->i", x, x), 0))
        return np.concatenate([x, more[:, None]], axis=1)

    def between(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Distances of points on the sphere."""
        return np.sqrt(np.maximum(2 * self.bound - 2 * (a @ b.T), 0))

    def reach(self, square: np.ndarray, score) -> np.ndarray:
        """Distance from a query, whose ``square`` is its squared norm, at which the inner product is ``score``."""
        return np.sqrt(np.maximum(square + self.bound - 2 * score, 0))

    def slack(self) -> float:
        return SLACK * math.sqrt(self.bound)


_ENTRY = "cell int, part int, page int, child int, point bigint, codes array<bigint>, ids array<bigint>, radius double, to_parent double"


def build_tree(x: np.ndarray, to_parent: np.ndarray, space: Space, page: int = PAGE) -> dict[str, np.ndarray]:
    """Entries of a bulk-loaded M-tree over lifted vectors: page, child (-1 in leaves), row (of x), radius, to_parent. The root is page 0."""
    entries, todo, pages = [], [(0, np.arange(len(x)), to_parent)], 1
    while todo:
        number, rows, above = todo.pop()
        if len(rows) <= page:
            entries.append((np.full(len(rows), number), np.full(len(rows), -1), rows, np.zeros(len(rows)), above))
            continue
        n = min(page, 2 * math.ceil(len(rows) / page))
        seeds = np.linspace(0, len(rows) - 1, n).astype(np.int64)
        apart = space.between(x[rows], x[rows[seeds]])
        nearest = apart.argmin(axis=1)
        if (nearest == nearest[0]).all():
            nearest = np.arange(len(rows)) % n
        for s in np.unique(nearest):
            mine = np.flatnonzero(nearest == s)
            own = apart[mine, s]
            entries.append(([number], [pages], rows[seeds[[s]]], [own.max()], above[seeds[[s]]]))
            todo.append((pages, rows[mine], own))
            pages += 1
    names = ("page", "child", "row", "radius", "to_parent")
    return {n: np.concatenate(c) for n, c in zip(names, zip(*entries, strict=True), strict=True)}


class Tree:
    """The stored entries of one part."""

    def __init__(self, table: pa.Table, space: Space):
        table = table.sort_by("page")
        page = table["page"].to_numpy()
        self.edges = np.searchsorted(page, np.arange(page[-1] + 2)).tolist()
        self.child, self.radius, self.to_parent = (table[c].to_numpy() for c in ("child", "radius", "to_parent"))
        self.ids, self.codes, self.point = table["ids"], table["codes"].combine_chunks(), table["point"].to_pylist()
        self.points = matrix(self.codes, space.dims)
        self.largest = float(np.abs(self.points).max(initial=0))
        self.space = space

    def search(self, codes: list[int], q: np.ndarray, to_root: float, least: int | None, k: int) -> tuple[list[tuple[int, int, int]], int]:
        """Best ``k`` of (-score, id, point) that reach the score ``least``, and how many distances that took."""
        space, square, slack = self.space, float(q @ q), self.space.slack()
        # Doubles add whole numbers exactly below 2**53; else leaves are scored by Python's own numbers.
        exact = self.largest * float(np.abs(q).max(initial=0)) * len(q) < 2**53
        within = math.inf if least is None else float(space.reach(square, float(least))) + slack
        best: list[tuple[int, int, int]] = []
        computed, heap = 0, [(0.0, 0, to_root)]
        while heap:
            low, page, to_page = heappop(heap)
            if low > within:
                break
            a, b = self.edges[page], self.edges[page + 1]
            near = np.flatnonzero(np.abs(to_page - self.to_parent[a:b]) - self.radius[a:b] <= within) + a
            computed += len(near)
            scores = (self.points[a:b] if len(near) == b - a else self.points[near]) @ q
            if self.child[a] >= 0:
                apart = space.reach(square, scores)
                for e, d in zip(near.tolist(), apart.tolist(), strict=True):
                    if d - self.radius[e] <= within:
                        heappush(heap, (max(0.0, d - self.radius[e]), int(self.child[e]), d))
                continue
            if exact:
                if least is None and len(near) > k:
                    near, scores = (x[scores >= np.partition(scores, -k)[-k]] for x in (near, scores))
                elif least is not None:
                    near, scores = (x[scores >= least] for x in (near, scores))
            for e, score in zip(near.tolist(), scores.tolist(), strict=True):
                score = int(score) if exact else sum(x * y for x, y in zip(self.codes[e].as_py(), codes, strict=False))
                score = min(max(score, _LONG[0]), _LONG[1])
                if least is None or score >= least:
                    best += [(-score, i, self.point[e]) for i in self.ids[e].as_py()]
            if len(near):
                best.sort()
                del best[k:]
            if len(best) == k and (least is None or -best[-1][0] > least):
                least = -best[-1][0]
                within = float(space.reach(square, float(least))) + slack
        return best, computed


def _assigned(nodes: DataFrame, space: Space) -> DataFrame:
    """The nodes with their cell, whose routing object is the nearest, and the distance to that."""
    pivots = space.lifted(space.pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                apart = space.between(space.lifted(matrix(batch["codes"], space.dims)), pivots)
                cell = apart.argmin(axis=1)
                columns = [*batch.columns, pa.array(cell, pa.int32()), pa.array(apart[np.arange(len(cell)), cell])]
                yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "cell", "to_pivot"])

    return nodes.mapInArrow(run, "id bigint, codes array<bigint>, ids array<bigint>, cell int, to_pivot double")


def build_pages(dealt: DataFrame, space: Space) -> DataFrame:
    """The entries of all parts' trees."""
    def run(table: pa.Table) -> pa.Table:
        tree = build_tree(space.lifted(matrix(table["codes"].combine_chunks(), space.dims)), table["to_pivot"].to_numpy(), space)
        row, n = pa.array(tree["row"]), len(tree["row"])
        ids = table["ids"].combine_chunks().take(pa.array(np.where(tree["child"] < 0, tree["row"], 0)))
        key = {c: pa.array(np.full(n, table[c][0].as_py()), pa.int32()) for c in ("cell", "part")}
        return pa.table(key | {
            "page": pa.array(tree["page"], pa.int32()), "child": pa.array(tree["child"], pa.int32()),
            "point": table["id"].combine_chunks().take(row), "codes": table["codes"].combine_chunks().take(row), "ids": ids,
            "radius": pa.array(tree["radius"], pa.float64()), "to_parent": pa.array(tree["to_parent"], pa.float64()),
        })

    return dealt.groupBy("cell", "part").applyInArrow(run, _ENTRY)


def _routed(asked: DataFrame, space: Space, first: int, last: int | None) -> DataFrame:
    """Visits of queries (node, codes, cell, part, least) to parts: cells ``first`` to ``last`` by least possible distance, those left
    out that can't hold a score of ``least``, and the query's own part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            q = matrix(batch["codes"], space.dims)
            square = np.einsum("ij,ij->i", q, q)
            apart = space.reach(square[:, None], q @ space.pivots.T)
            low = np.maximum(apart - space.radius, 0)
            least = np.array([-math.inf if v is None else float(v) for v in batch["least"].to_pylist()])
            within = space.reach(square, least) + space.slack()
            order = np.lexsort((apart, low), axis=1)[:, first:last]
            at = np.repeat(np.arange(len(q)), order.shape[1])
            cell = order.reshape(-1)
            keep = low[at, cell] <= within[at]
            at, cell = at[keep], cell[keep]
            some = batch.take(pa.array(at))
            yield pa.RecordBatch.from_arrays([
                some["node"], some["codes"], some["least"], some["cell"], some["part"], pa.array(cell, pa.int32()),
                pa.array(space.parts[cell], pa.int32()), pa.array(apart[at, cell]),
            ], names=["node", "codes", "least", "own_cell", "own_part", "cell", "parts", "to_root"])

    schema = "node bigint, codes array<bigint>, least bigint, own_cell int, own_part int, cell int, parts int, to_root double"
    each = asked.mapInArrow(run, schema).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    own = (F.col("cell") == F.col("own_cell")) & (F.col("part") == F.col("own_part"))
    return each.where(~own).select("node", "codes", "least", "cell", "part", "to_root")


def _at_home(asked: DataFrame, space: Space) -> DataFrame:
    """Visits of queries to the parts that they lie in."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q = matrix(batch["codes"], space.dims)
            cell = batch["cell"].to_numpy()
            to_root = space.reach(np.einsum("ij,ij->i", q, q), np.einsum("ij,ij->i", q, space.pivots[cell]))
            yield batch.append_column("to_root", pa.array(to_root))

    schema = "node bigint, codes array<bigint>, cell int, part int, least bigint, to_root double"
    return asked.select("node", "codes", "cell", "part", "least").mapInArrow(run, schema)


def search_parts(visits: DataFrame, pages: DataFrame, space: Space, k: int, per_task: int = VISITS) -> DataFrame:
    """node, vec_id, point, score: for each visit the best ``k`` of the part that reach the query's ``least``."""
    blocks = visits.groupBy("cell", "part").agg(F.ceil(F.count("*") / per_task).cast("int").alias("blocks"))
    dealt = visits.join(blocks, ["cell", "part"]).withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int")).drop("blocks")
    copies = pages.join(blocks, ["cell", "part"]).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")

    def run(asked: pa.Table, entries: pa.Table) -> pa.Table:
        found = []
        if asked.num_rows and entries.num_rows:
            tree, codes = Tree(entries, space), asked["codes"].combine_chunks()
            points = matrix(codes, space.dims)
            rows = zip(asked["node"].to_pylist(), asked["to_root"].to_pylist(), asked["least"].to_pylist(), strict=True)
            for at, (node, to_root, least) in enumerate(rows):
                best, _ = tree.search(codes[at].as_py(), points[at], to_root, least, k)
                found += [{"node": node, "vec_id": i, "point": point, "score": -minus} for minus, i, point in best]
        return pa.Table.from_pylist(found, pa.schema([(c, pa.int64()) for c in ("node", "vec_id", "point", "score")]))

    key = ["cell", "part", "block"]
    return dealt.groupBy(*key).cogroup(copies.groupBy(*key)).applyInArrow(run, "node bigint, vec_id bigint, point bigint, score bigint")


def _best(found: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id", "point")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(
    vectors: DataFrame, is_query, *, key: str = "vec_id", vector: str = "embedding", k: int = 5, part: int = PART, pivots: int = PIVOTS,
    nearest_cells: int = NEAREST_CELLS,
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` largest inner products of each query row, ``is_query`` being a condition on a column ``id``.

    All usable rows (see `usable`) but the query's own are candidates. Fewer candidates give fewer rows.
    """
    spark = vectors.sparkSession
    rows = stored(usable(vectors, key, vector), "vectors")
    smallest = Window.partitionBy("codes").orderBy("id")
    some = rows.withColumn("place", F.row_number().over(smallest)).where(F.col("place") <= k + 1)
    nodes = some.groupBy("codes").agg(F.min("id").alias("first"), F.sort_array(F.collect_list("id")).alias("ids"))
    # Ids may repeat with other vectors, so a node's own number comes from the vector too.
    nodes = stored(nodes.select(F.xxhash64("first", "codes").alias("id"), "codes", "ids"), "nodes")
    square = F.aggregate("codes", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    n, dims, bound = nodes.agg(F.count("*"), F.max(F.size("codes")), F.max(square)).first()
    if not n:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    # About twice the routing objects wanted are drawn, by a digest of the id; the first of these are taken.
    wanted = max(1, min(pivots, math.ceil(2 * n / part)))
    drawn = F.pmod("id", F.lit(1 << 40)) <= (1 << 40) * min(1.0, 2 * wanted / n)
    sample = nodes.where(drawn).orderBy("id").limit(wanted).select("codes").toArrow()["codes"].combine_chunks()
    if not len(sample):
        sample = nodes.limit(1).select("codes").toArrow()["codes"].combine_chunks()
    space = Space(dims, bound, matrix(sample, dims))
    assigned = stored(_assigned(nodes, space), "assigned")
    cells = assigned.groupBy("cell").agg(F.max("to_pivot").alias("radius"), F.ceil(F.count("*") / part).cast("int").alias("parts"))
    radius, parts = np.zeros(len(sample)), np.zeros(len(sample), np.int32)
    for row in cells.collect():  # one row for each routing object
        radius[row["cell"]], parts[row["cell"]] = row["radius"], row["parts"]
    # Routing objects without vectors of their own have nothing to visit.
    space = Space(dims, bound, space.pivots, np.where(parts > 0, radius, -math.inf), parts)
    dealt = assigned.join(cells.select("cell", "parts"), "cell").withColumn("part", F.pmod("id", "parts").cast("int")).drop("parts")
    dealt = stored(dealt, "dealt")
    pages = stored(build_pages(dealt, space), "pages")
    asking = stored(rows.where(is_query).join(nodes.select(F.col("id").alias("node"), "codes"), "codes").select(F.col("id").alias("query_id"), "node"), "asking")
    asked = dealt.join(asking.select(F.col("node").alias("id")).distinct(), "id", "left_semi").select(F.col("id").alias("node"), "codes", "cell", "part")
    asked = stored(asked.withColumn("least", F.lit(None).cast("bigint")), "asked")
    found = stored(search_parts(_at_home(asked, space), pages, space, k + 1), "found")
    for first, last in ((0, nearest_cells), (nearest_cells, None)):
        if first >= len(sample):
            break
        full = _best(found, ["node"], k + 1).groupBy("node").agg(F.count("*").alias("n"), F.min("score").alias("score"))
        least = full.where(F.col("n") == k + 1).select("node", F.col("score").alias("least"))
        more = search_parts(_routed(asked.drop("least").join(least, "node", "left"), space, first, last), pages, space, k + 1)
        found = stored(_best(found.unionByName(more), ["node"], k + 1).drop("rank"), "found")
    pairs = asking.join(found, "node")
    itself = (F.col("vec_id") == F.col("query_id")) & (F.col("point") == F.col("node"))
    ranked = _best(pairs.where(~itself), ["query_id", "node"], k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
