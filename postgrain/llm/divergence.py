"""How far the sources of a language differ in their terms, by Gustavson's row accumulation.

Documents become counts of (lang, source, term) while they are read. What is left of them is a sparse matrix for each language:
a row for each source, a column for each kept term. It is cut into slices of terms. In a slice each row scatters the rows of the
term-major index that it touches into a dense accumulator, one place for each peer, so no pair of postings becomes a row.
A missing entry isn't zero here but the smoothed share of a count of zero, its source's baseline; accumulators hold what
entries change about the distance of the baselines, which is added once for each slice.

Every row of the input is a document, repeated rows too. A null text, lang or source counts as ''. Empty texts still make their
group occur. Very long texts are counted piece by piece. An empty table gives no rows. Other columns are ignored. Values tie
often; ranks then follow the UTF-8 bytes of the item.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postgrain.llm.store import stored

LEAST_DOCUMENTS = 30
SMOOTHING = 5
SCALE = 1_000_000_000
TOP_TERMS = 50
# Postings that a task holds at once, counts of terms that a task gathers before it passes them on, bytes of text it cuts at once.
SLICE_POSTINGS = 1 << 17
FLUSH = 1 << 19
PIECE_BYTES = 1 << 20

# Letters of ASCII and all other characters: in UTF-8, the bytes of these alone.
_TERM = re.compile(rb"[A-Za-z\x80-\xff]+")
_END = re.compile(rb"[^A-Za-z\x80-\xff]")
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def terms_of(text: bytes) -> Counter:
    """How often each term occurs, cut at breaks between terms so that a long text is not a list of all its terms at once."""
    counts, at = Counter(), 0
    while at < len(text):
        cut = _END.search(text, at + PIECE_BYTES)
        end = cut.start() if cut else len(text)
        counts.update(_TERM.findall(text[at:end].translate(_LOWER)))
        at = end
    return counts


def count_terms(documents: DataFrame) -> DataFrame:
    """lang, source, term, n, docs: occurrences and documents of each term; of each group also a row without term (n = 0)."""
    def rows(counts: dict, docs: dict) -> pa.RecordBatch:
        keys = [(*group, term, n, docs[group][term]) for group, terms in counts.items() for term, n in terms.items()]
        keys += [(*group, None, 0, 0) for group in counts]
        lang, source, term, n, docs = zip(*keys, strict=True)
        return pa.RecordBatch.from_arrays([
            pa.array(lang, pa.string()), pa.array(source, pa.string()), pa.array(term, pa.binary()).cast(pa.string()),
            pa.array(n, pa.int64()), pa.array(docs, pa.int64()),
        ], names=["lang", "source", "term", "n", "docs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, docs, held = defaultdict(Counter), defaultdict(Counter), 0
        for batch in batches:
            texts = batch["text"].cast(pa.large_binary())
            for text, *group in zip(texts, batch["lang"].to_pylist(), batch["source"].to_pylist(), strict=True):
                found, group = terms_of(text.as_buffer().to_pybytes()), tuple(group)
                held -= len(counts[group])
                counts[group].update(found)
                docs[group].update(found.keys())
                held += len(counts[group])
                if held > FLUSH:
                    yield rows(counts, docs)
                    counts, docs, held = defaultdict(Counter), defaultdict(Counter), 0
        if counts:
            yield rows(counts, docs)

    columns = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")]
    found = documents.select(*columns).mapInArrow(run, "lang string, source string, term string, n bigint, docs bigint")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def shares(counts: np.ndarray, total: np.ndarray, n_terms: int) -> np.ndarray:
    """1 + floor(SCALE * (count + SMOOTHING) / (total + SMOOTHING * n_terms)) in whole numbers, three digits at a time."""
    whole, left = np.divmod(counts.astype(np.int64) + SMOOTHING, total + SMOOTHING * n_terms)
    for _ in range(3):
        digits, left = np.divmod(left * 1000, total + SMOOTHING * n_terms)
        whole = whole * 1000 + digits
    return whole + 1


def accumulate(term: np.ndarray, row: np.ndarray, p: np.ndarray, base: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(row, ahead, back) for each row, over the terms of a slice: the distance to peer h is ahead[h] of the row + back[row] of h.

    ``term``, ``row``, ``p``: the postings in order of terms; ``base``: each row's share of a count of zero.
    """
    n_terms = int(term[-1]) + 1 if len(term) else 0
    starts = np.searchsorted(term, np.arange(n_terms + 1))
    by_row = np.argsort(row, kind="stable")
    edges = np.searchsorted(row[by_row], np.arange(len(base) + 1))
    for g in range(len(base)):
        mine = by_row[edges[g] : edges[g + 1]]
        own, size = p[mine], starts[term[mine] + 1] - starts[term[mine]]
        # My entries against the baselines of all peers, less what the baselines differ anyway.
        order = np.sort(own)
        sums = np.concatenate([[0], np.cumsum(order, dtype=np.int64)])
        below = np.searchsorted(order, base)
        apart = np.abs(base - base[g])
        back = base * below - sums[below] + sums[-1] - sums[below] - base * (len(own) - below) - apart * len(own)
        ahead = back + apart * n_terms
        # The peers' entries in my terms: what they change about that, scattered by peer.
        index = np.repeat(starts[term[mine]] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        peer, theirs, own = row[index], p[index], np.repeat(own, size)
        change = np.abs(own - theirs) - np.abs(own - base[peer]) - np.abs(theirs - base[g]) + apart[peer]
        np.add.at(ahead, peer, change)
        yield g, ahead, back


def _distances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All rows of one slice: those without a term list the language's sources. Yields what each pair of sources sums to."""
    table = pa.Table.from_batches(batches)
    lang = table["lang"][0].as_py()
    group = table["term"].is_null()
    peers = table.filter(group).sort_by("source")
    names, totals = peers["source"].combine_chunks(), peers["total"].to_numpy()
    postings = table.filter(pc.invert(group)).sort_by("term")
    term = postings["term"].combine_chunks().dictionary_encode()
    term = term.indices.to_numpy(zero_copy_only=False).astype(np.int64) if len(term) else np.empty(0, np.int64)
    row = pc.index_in(postings["source"].combine_chunks(), value_set=names).to_numpy(zero_copy_only=False).astype(np.int64)
    n_terms = peers["n_terms"][0].as_py()
    base, p = np.zeros(len(names), np.int64), np.zeros(len(row), np.int64)
    if n_terms:
        n = postings["n"].to_numpy()
        base = shares(base, totals, n_terms)
        p = shares(n, totals[row], n_terms)
    for g, ahead, back in accumulate(term, row, p, base):
        others = np.flatnonzero(np.arange(len(base)) != g)
        n = len(others)
        yield pa.RecordBatch.from_arrays([
            pa.array([lang] * n, pa.string()), pa.array([names[g].as_py()] * n, pa.string()), names.take(pa.array(others)),
            pa.array(ahead[others]), pa.array(back[others]),
        ], names=["lang", "source", "peer", "ahead", "back"])


def audit(documents: DataFrame, *, least_documents: int = LEAST_DOCUMENTS, top_terms: int = TOP_TERMS, slice_postings: int = SLICE_POSTINGS) -> DataFrame:
    """lang, source, part, item, value, rank: each source against its peers (``pair``) and its language (``term``).

    Terms in at least ``least_documents`` documents of their language are kept. ``pair``: the sum over kept terms of the
    differences of shares, for all other sources of the language. ``term``: the terms that the source uses more than its language does, up to
    ``top_terms``. Shares are whole numbers of billionths, rounded down, plus one; all sums are exact.
    """
    counts = stored(count_terms(documents), "counts")
    groups = counts.where(F.col("term").isNull()).select("lang", "source")
    by_term = Window.partitionBy("lang", "term")
    kept = (
        counts.where(F.col("term").isNotNull())
        .select("lang", "term", "source", "n", F.sum("docs").over(by_term).alias("in_docs"), F.sum("n").over(by_term).alias("all_n"))
        .where(F.col("in_docs") >= least_documents).drop("in_docs")
    )
    kept = stored(kept, "kept")
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = kept.groupBy("lang", "term").agg(F.first("all_n").alias("n"), F.count("*").alias("postings")).groupBy("lang").agg(
        F.count("*").alias("n_terms"), F.sum("n").alias("lang_total"), F.sum("postings").alias("postings")
    )
    sources = groups.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").select(
        "lang", "source", *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("total", "n_terms", "lang_total", "postings")]
    )
    sources = stored(sources, "sources")
    slices = F.greatest(F.lit(1), F.ceil(F.col("postings") / slice_postings)).cast("int")
    listed = sources.select(
        "lang", F.explode(F.sequence(F.lit(0), slices - 1)).alias("slice"), "source", F.lit(None).cast("string").alias("term"),
        F.lit(0).cast("bigint").alias("n"), "total", "n_terms",
    )
    nothing = F.lit(None).cast("bigint")
    postings = kept.join(sources.select("lang", slices.alias("slices")).distinct(), "lang").select(
        "lang", F.pmod(F.xxhash64("term"), "slices").cast("int").alias("slice"), "source", "term", "n", nothing.alias("total"), nothing.alias("n_terms"),
    )
    sliced = listed.unionByName(postings).groupBy("lang", "slice").applyInArrow(
        _distances, "lang string, source string, peer string, ahead bigint, back bigint"
    )
    both = sliced.select("lang", F.explode(F.array(
        F.struct("source", F.col("peer").alias("item"), F.col("ahead").alias("value")),
        F.struct(F.col("peer").alias("source"), F.col("source").alias("item"), F.col("back").alias("value")),
    )).alias("side")).select("lang", "side.*")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = both.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")).withColumn("rank", F.row_number().over(order))

    def share(n: str, total: str):
        return F.expr(
            f"1 + (({SCALE}BD * cast({n} + {SMOOTHING} as decimal(20, 0))) div cast({total} + {SMOOTHING} * n_terms as decimal(20, 0)))"
        )

    excess = (share("n", "total") - share("all_n", "lang_total")).cast("bigint")
    own = kept.join(sources.drop("postings"), ["lang", "source"]).select("lang", "source", F.col("term").alias("item"), excess.alias("value"))
    terms = own.where(F.col("value") > 0).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top_terms)
    columns = lambda part: ["lang", "source", F.lit(part).alias("part"), "item", "value", "rank"]
    return pairs.select(*columns("pair")).unionByName(terms.select(*columns("term")))

