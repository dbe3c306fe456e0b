from __future__ import annotations

import collections
import random
import re

import numpy as np
import pytest

from postgrain.llm.components import components
from postgrain.llm.blocks import packed_sorted
from postgrain.llm.jaccard_join import (
    _by_rarest, _differing, _in_turn, _maps, _rarest, _verified, allocation, bands, component_of, one_of_each, signatures, similar,
)
from postgrain.llm.queries import QUERIES
from tests.llm.data import documents, odd_rows, with_clashes


def shingle_set(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def slow(rows):
    """(doc_id, size, component) of each row, from all pairs."""
    sets = [shingle_set(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    at = collections.defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            at[x].append(i)
    for i, s in enumerate(sets):
        common = collections.Counter(j for x in s for j in at[x] if j < i)
        for j, n in common.items():
            if 100 * n >= 75 * (len(s) + len(sets[j]) - n):
                root[find(i)] = find(j)
    ids = collections.defaultdict(list)
    for i, r in enumerate(rows):
        ids[find(i)].append(r[0])
    least = {k: min((x for x in v if x is not None), default=None) for k, v in ids.items()}
    return collections.Counter((r[0], len(s), least[find(i)]) for i, (r, s) in enumerate(zip(rows, sets, strict=True)))


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(4))
    line = [word() for _ in range(9)]
    rows = []
    for _ in range(14):
        base = [word() for _ in range(rng.choice([1, 3, 5, 6, 8, 12, 20, 60, 150, 400]))]
        if rng.random() < 0.4:
            base = line + base
        for _ in range(rng.choice([1, 2, 6, 25])):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, len(text) // 40, len(text) // 25])):
                at = rng.randrange(len(text) or 1)
                text[at : at + 1] = rng.choice([[word()], [], [word(), word()]])
            rows.append(" ".join(w.upper() if rng.random() < 0.05 else w for w in text))
    rng.shuffle(rows)
    return [(i, t, "en", "s") for i, t in enumerate(rows)]


def bag(df):
    return collections.Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize(("seed", "crowd"), [(1, 16), (2, 1), (3, 3)])
def test_same_as_all_pairs(spark, seed, crowd):
    rows = corpus(seed)
    got = component_of(documents(spark, rows).repartition(3), crowd=crowd)
    assert bag(got.select("doc_id", "n_shingles", "component_id")) == slow(rows)


def test_odd_rows(spark):
    rows = odd_rows()
    df = with_clashes(documents(spark, rows), "key", "node", "root", "size", "a", "b")
    want = slow(rows)
    assert bag(component_of(df)) == want
    assert component_of(df.limit(0)).count() == 0
    kept = one_of_each(df)
    assert kept.columns == df.columns
    firsts = collections.Counter(r[0] for r in rows if not shingle_set(r[1]))
    for component in {k[2] for k in want if k[1]}:
        firsts[component] += 1
    assert collections.Counter(r["doc_id"] for r in kept.collect()) == firsts


@pytest.mark.parametrize("whole", [True, False])
def test_groups_that_share_a_phrase_and_a_chain_between_them(spark, whole):
    """Two groups of near copies with half their words in common; single documents lead from one to the other, or stop short of it."""
    rng = random.Random(9)
    phrase = [f"p{i}" for i in range(60)]
    here, there = ([f"{side}{i}" for i in range(60)] for side in "ab")

    def copy(tail):
        tail = list(tail)
        tail[rng.randrange(60)] = f"x{rng.randrange(10**6)}"
        return " ".join(phrase + tail)

    texts = [copy(tail) for tail in (here, there) for _ in range(120)]
    steps = range(6, 60, 6) if whole else [n for n in range(6, 60, 6) if n not in (24, 30, 36)]
    texts += [" ".join(phrase + there[:n] + here[n:]) for n in steps]
    rng.shuffle(texts)
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)]
    got = bag(component_of(documents(spark, rows).repartition(3)).select("doc_id", "n_shingles", "component_id"))
    assert got == slow(rows)
    assert len({component for _, _, component in got}) == (1 if whole else 2)


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r)[:2] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert bag(QUERIES["op5_jaccard_join"](spark, sf)) == slow(rows)


def test_similar_sets_share_a_signature_unless_both_lack_slack():
    rng = np.random.default_rng(4)
    for _ in range(400):
        n = int(rng.integers(1, 300))
        x = rng.integers(0, 2**64, n, dtype=np.uint64)
        keep = int(rng.integers(n * 3 // 4, n + 1))
        most = max(0, n * 4 // 3 - n)
        y = np.concatenate([x[:keep], rng.integers(0, 2**64, int(rng.integers(0, most + 1)), dtype=np.uint64)])
        x, y = np.unique(x), np.unique(y)
        common = len(np.intersect1d(x, y))
        if 100 * common < 75 * (len(x) + len(y) - common):
            continue
        for single in (False, True):
            sig, row, takes, left = signatures(np.concatenate([x, y]), np.array([0, len(x), len(x) + len(y)]), single)
            if max(min(left[takes == 0]), min(left[takes == 1])) >= 0:
                assert np.intersect1d(sig[row == 0], sig[row == 1]).size


def test_allocations_cover_the_differences():
    edges = bands(5000)
    kinds = set()
    for low, high in zip(edges.tolist(), (edges[1:] - 1).tolist(), strict=False):
        plan = allocation(low, high)
        if plan:
            deletions, _, exact, slack = plan
            kinds.add(deletions > 0)
            assert 2 * deletions + exact - slack == (high + high * 4 // 3) // 7 + 1
    assert kinds == {False, True}


def test_components(spark):
    rng = random.Random(5)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(300)] + [(500 + i, 501 + i) for i in range(60)] + [(1000, 1001 + i) for i in range(50)]
    root = {n: n for link in links for n in link if link[0] != link[1]}
    for _ in range(400):
        for a, b in links:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r["node"]: r["root"] for r in got} == root and len(got) == len(root)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def stored_sets(spark, sets):
    """Sets of numbers as `_sets_of` stores them, named by their place."""
    values = [np.array(sorted(s), np.uint64) for s in sets]
    maps = _maps(np.concatenate(values), np.cumsum([0, *map(len, values)]))
    rows = [(i, len(v), bytearray(m), bytearray(packed_sorted(v))) for i, (v, m) in enumerate(zip(values, maps, strict=True))]
    return spark.createDataFrame(rows, "node bigint, size bigint, map binary, items binary")


def all_links(sets):
    return {(i, j) for i, s in enumerate(sets) for j, t in enumerate(sets[:i]) if similar(len(s & t), len(s), len(t))}


def either_way(df):
    return {(max(r["a"], r["b"]), min(r["a"], r["b"])) for r in df.collect()}


def edited(rng, sizes):
    """Sets that have most of one of two bases and some shingles of their own."""
    new = lambda n: {rng.getrandbits(63) for _ in range(n)}
    bases = [sorted(new(120)) for _ in range(2)]
    return [set(rng.sample(bases[i % 2], n)) | new(rng.choice([0, 3, 12, 20])) for i, n in enumerate(sizes)]


def test_rarest_shingles_lead_to_all_links(spark):
    rng = random.Random(4)
    sets = edited(rng, [rng.randrange(80, 121) for _ in range(90)])
    stored = stored_sets(spark, sets)
    nodes = stored.selectExpr("node", "size", "node as root")
    pairs = _by_rarest(_rarest(nodes, stored), spark.createDataFrame([], "node bigint, root bigint"))
    found, links = either_way(pairs), all_links(sets)
    assert links and links <= found
    assert len(found) == pairs.count()
    assert either_way(_verified(pairs, stored)) == links


def test_sets_with_much_in_common_do_not_meet(spark):
    """Three quarters of each set in all of them: 0.6 similar."""
    rng = random.Random(5)
    shared = {rng.getrandbits(63) for _ in range(75)}
    sets = [shared | {rng.getrandbits(63) for _ in range(25)} for _ in range(40)]
    stored = stored_sets(spark, sets)
    nodes = stored.selectExpr("node", "size", "node as root")
    assert _by_rarest(_rarest(nodes, stored), spark.createDataFrame([], "node bigint, root bigint")).count() == 0


def test_maps_differ_in_no_more_bits_than_sets():
    rng = random.Random(6)
    sets = edited(rng, [*[rng.randrange(1, 121) for _ in range(60)], 1, 2]) + [{rng.getrandbits(63) for _ in range(9000)}]
    values = [np.array(sorted(s), np.uint64) for s in sets]
    maps = _maps(np.concatenate(values), np.cumsum([0, *map(len, values)]))
    pairs = [(i, j) for i in range(len(sets)) for j in range(len(sets))]
    bits = _differing([maps[i] for i, _ in pairs], [maps[j] for _, j in pairs])
    apart = np.array([len(sets[i] ^ sets[j]) for i, j in pairs])
    assert (bits <= apart).all()
    assert ((bits > 0) == (apart > 0)).mean() > 0.99
    assert len({len(m) for m in maps}) > 3 and max(map(len, maps)) <= 2048
    assert _maps(np.empty(0, np.uint64), np.zeros(1, np.int64)) == []


def test_nodes_in_turn_link_a_cluster_by_few_pairs(spark):
    rng = random.Random(7)
    base = sorted(rng.getrandbits(63) for _ in range(120))
    sets = [set(rng.sample(base, 114)) | {rng.getrandbits(63) for _ in range(6)} for _ in range(80)]
    stored = stored_sets(spark, sets)
    rarest = _rarest(stored.selectExpr("node", "size", "node as root"), stored)
    pairs = _in_turn(rarest, spark.createDataFrame([], "node bigint, root bigint"), 0)
    assert pairs.count() <= rarest.count()
    roots = components(_verified(pairs, stored))
    assert roots.where("root = 0").count() == len(sets)
    # What is one group needs no comparison.
    assert _in_turn(rarest, roots, 1).count() == 0
    assert _by_rarest(rarest, roots).count() == 0
