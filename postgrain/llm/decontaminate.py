"""Benchmark passages in documents, in DataFrame and SQL functions only.

A document holds a benchmark item when one of its windows of as many words as the item is similar enough: the weighted Jaccard
similarity of their shingles, each weighing as often as it occurs. Every window that can be similar enough is tried: of two bags of
m shingles each, at least 2 m `least` / (1 + `least`) must be shared, so only windows with as many places that hold a shingle of
the item can. None is passed over for where these places stand.

Each window gets a 64-bit SimHash of its weighted shingles, as each item does. Fingerprints within `radius` bits of an item's
agree with it, in at least one of `blocks` blocks of bits, up to radius // blocks of them. Items are therefore indexed by all
block values within that distance, and a window, which is tried for the items that share enough with it, fetches those of them that share a block; none
within the radius is missed. Candidates within the radius are verified on their shingles. Texts with windows are cut into shingles once.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postgrain.llm.store import stored

SHINGLE = 5
SIMILARITY = 0.75
# At a similarity of 0.75 fingerprints differ in 11 bits on average, with a standard deviation of 3: this leaves four of those.
RADIUS = 23
BLOCKS = 8
# Keys of 32 characters that are sent to all tasks at most.
SENT_KEYS = 500_000


def word_list(text: Column) -> Column:
    """Lower-case runs without 0x20 and 0x09-0x0D."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def shingle_hashes(words: str, k: int) -> Column:
    """A hash of each run of k words, in order."""
    return F.expr(
        f"if(size({words}) < {k}, cast(array() as array<bigint>), transform(sequence(1, size({words}) - {k - 1}), i -> xxhash64(slice({words}, i, {k}))))"
    )


# Shingles that 16-bit counters in one long can count.
_COUNTED = 32767


def simhash(hashes: str) -> Column:
    """Bit b is set where shingles with that bit outweigh those without; repeated shingles count each time.

    Sixteen sums count four bits each, 16 bits apart; more shingles than these can count are counted bit by bit.
    """
    sums = ", ".join(f"aggregate({hashes}, 0L, (s, h) -> s + (shiftrightunsigned(h, {j}) & {0x0001000100010001}L))" for j in range(16))
    packed = "(shiftrightunsigned(sums[b % 16], 16 * (b div 16)) & 65535L)"
    single = f"size(filter({hashes}, h -> (shiftright(h, b) & 1L) = 1L))"
    bits = lambda ones: f"aggregate(sequence(0, 63), 0L, (f, b) -> f | shiftleft(cast(2 * {ones} > size({hashes}) as bigint), b))"
    few = f"transform(array(array({sums})), sums -> {bits(packed)})[0]"
    return F.expr(f"if(size({hashes}) <= {_COUNTED}, {few}, {bits(single)})")


def similarity(a: str, b: str) -> Column:
    """Weighted Jaccard similarity of two arrays as bags; of two without repeated values it is that of sets."""
    bags = f"aggregate(array_distinct({a}), 0L, (s, h) -> s + least(size(filter({a}, x -> x = h)), size(filter({b}, x -> x = h))))"
    plain = f"size(array_distinct({a})) = size({a}) AND size(array_distinct({b})) = size({b})"
    shared = f"if({plain}, cast(size(array_intersect({a}, {b})) as bigint), {bags})"
    return F.expr(f"transform(array({shared}), n -> n / (size({a}) + size({b}) - n))[0]")


def _starts(least: float) -> Column:
    """First words of all windows that hold enough of the sorted ``places``, each once, within the document.

    A window holds the i-th place and as many after it as are needed when it begins between what the last of these still allows and the
    i-th place itself; those that begin at an earlier place or before it hold that one too, and are given with it.
    """
    shingles = "(n_words - k + 1)"
    need = f"greatest(1, cast(ceil({2 * least / (1 + least)!r}D * {shingles} - 1e-9D) as int))"
    low = f"greatest(0, places[i + {need} - 1] - {shingles} + 1, if(i > 0, places[i - 1] + 1, 0))"
    high = "least(places[i], doc_words - n_words)"
    return F.expr(
        f"flatten(transform(if(size(places) < {need}, cast(array() as array<int>), sequence(0, size(places) - {need})), "
        f"i -> if({low} <= {high}, sequence({low}, {high}), cast(array() as array<int>))))"
    )


def _block_values(radius: int, blocks: int) -> list[tuple[int, list[int]]]:
    """For each block of bits, where it begins and all differences that its values may have."""
    width = 64 // blocks
    near = range(radius // blocks + 1)
    masks = [sum(1 << b for b in some) for n in near for some in combinations(range(width), n)]
    return [(block * width, masks) for block in range(blocks)]


def _block(fingerprint: str, begin: int, blocks: int) -> str:
    return f"(shiftrightunsigned({fingerprint}, {begin}) & {(1 << (64 // blocks)) - 1}L)"


def contaminated(
    documents: DataFrame, benchmark: DataFrame, *, k: int = SHINGLE, least: float = SIMILARITY, radius: int = RADIUS, blocks: int = BLOCKS
) -> DataFrame:
    """One row per document and item found in it: doc_id, text_key, item_id, similarity (the best window's), start (its first
    word, from 0), distance (of fingerprints), n_windows (similar ones).

    Items of fewer than ``k`` words have all their words as their one shingle, and so have windows of their size. Items
    without words, documents without words and those shorter than an item match nothing. Documents with the same doc_id are told apart by
    ``text_key``, the MD5 of the text; repeated rows count once. Rows with a NULL doc_id or item_id are like others. Only doc_id, text,
    item_id and text are read. Empty tables give an empty result.
    """
    items = stored(_items(benchmark, k), "benchmark-items")
    sizes = [r[0] for r in items.select("k").distinct().orderBy("k").collect()]  # at most k values
    docs = documents.select("doc_id", "text", F.md5(F.coalesce("text", F.lit(""))).alias("text_key"))
    worded = docs.withColumn("words", word_list(F.col("text")))
    told = items.select("k", "item_key", "n_words", F.explode("hashes").alias("h"))
    hits = None
    for size in sizes:
        own = told.where(F.col("k") == size).select("item_key", "n_words", "h").distinct()
        at = worded.select("doc_id", "text_key", F.size("words").alias("doc_words"), F.posexplode(shingle_hashes("words", size)).alias("at", "h"))
        some = at.join(own, "h").select("doc_id", "text_key", "item_key", "n_words", "doc_words", "at", F.lit(size).alias("k"))
        hits = some if hits is None else hits.unionByName(some)
    schema = "doc_id %s, text_key string, item_id %s, similarity double, start int, distance int, n_windows bigint" % tuple(
        d.schema[c].dataType.simpleString() for d, c in ((documents, "doc_id"), (benchmark, "item_id"))
    )
    if hits is None:
        return documents.sparkSession.createDataFrame([], schema)
    places = hits.where(F.col("doc_words") >= F.col("n_words")).groupBy("doc_id", "text_key", "item_key", "n_words", "doc_words", "k").agg(
        F.sort_array(F.collect_set("at")).alias("places")
    )
    windows = places.select("doc_id", "text_key", "item_key", "n_words", "k", F.explode(_starts(least)).alias("start"))
    windows = stored(windows.distinct(), "benchmark-windows")
    wanted = windows.groupBy("text_key", "k").agg(F.collect_set(F.struct("item_key", "n_words", "start")).alias("windows"))
    held = stored(windows.select("text_key").distinct(), "benchmark-texts")
    # Few documents have windows; up to a checked number their keys go to all tasks, so that texts are not shuffled.
    held = F.broadcast(held) if held.count() <= SENT_KEYS else held
    texts = docs.join(held, "text_key", "left_semi").groupBy("text_key").agg(F.max("text").alias("text"))
    texts = texts.select("text_key", word_list(F.col("text")).alias("words")).join(wanted, "text_key")
    all_hashes = F.expr("transform(sequence(1, size(words) - k + 1), i -> xxhash64(slice(words, i, k)))")
    shingled = stored(texts.select("text_key", "k", "windows", all_hashes.alias("all_hashes")), "benchmark-shingles")
    window = "slice(all_hashes, start + 1, n_words - k + 1)"
    each = shingled.select("text_key", "k", "all_hashes", F.explode("windows").alias("w")).select("text_key", "k", "all_hashes", "w.*")
    printed = each.select("text_key", "item_key", "start", F.expr(window).alias("hashes")).select("text_key", "item_key", "start", simhash("hashes").alias("print"))
    printed = stored(printed, "benchmark-prints")
    values = _block_values(radius, blocks)
    key = lambda print_, begin, mask: f"named_struct('block', {begin}, 'value', {_block(print_, begin, blocks)} ^ {mask}L)"
    asked = F.expr("array(" + ", ".join(key("print", begin, 0) for begin, _ in values) + ")")
    masks = F.array(*[F.lit(m).cast("long") for m in values[0][1]])
    begins = F.array(*[F.lit(begin) for begin, _ in values])
    index = (
        items.select("item_id", "item_key", "n_words", F.col("print").alias("item_print"), F.col("hashes").alias("item_hashes"), F.explode(begins).alias("block"))
        .withColumn("mask", F.explode(masks))
        .select("item_id", "item_key", "n_words", "item_print", "item_hashes", "block",
                F.expr(f"(shiftrightunsigned(item_print, block) & {(1 << (64 // blocks)) - 1}L) ^ mask").alias("value"))
    )
    # Blocks first, with narrow rows; a pair that several blocks find is one pair.
    narrow = index.select("item_key", "item_print", "block", "value")
    pairs = (
        printed.select("text_key", "item_key", "start", "print", F.explode(asked).alias("b")).select("*", "b.block", "b.value").drop("b")
        .join(narrow, ["item_key", "block", "value"])
        .withColumn("distance", F.bit_count(F.expr("print ^ item_print"))).where(F.col("distance") <= radius)
        .select("text_key", "item_key", "start", "distance").distinct()
    )
    full = items.select("item_key", "item_id", "n_words", "k", F.col("hashes").alias("item_hashes"))
    found = (
        pairs.join(full, "item_key").join(shingled.drop("windows"), ["text_key", "k"]).withColumn("hashes", F.expr(window))
        .withColumn("similarity", similarity("hashes", "item_hashes")).where(F.col("similarity") >= least)
    )
    best = F.max_by(F.struct("start", "distance"), F.struct("similarity", -F.col("start")))
    by_text = found.groupBy("text_key", "item_key").agg(
        F.first("item_id").alias("item_id"), F.max("similarity").alias("similarity"), best.alias("best"), F.count("*").alias("n_windows")
    )
    named = windows.select("doc_id", "text_key").distinct()
    return named.join(by_text, "text_key").select(
        "doc_id", "text_key", "item_id", "similarity", F.col("best.start").alias("start"), F.col("best.distance").alias("distance"), "n_windows"
    )


def _items(benchmark: DataFrame, k: int) -> DataFrame:
    """item_id, item_key, n_words, k (words of a shingle), hashes, print of each item with words, repeated rows once."""
    rows = benchmark.select("item_id", "text").distinct().withColumn("words", word_list(F.col("text"))).where(F.size("words") > 0)
    rows = rows.withColumn("n_words", F.size("words")).withColumn("k", F.least("n_words", F.lit(k)))
    hashes = F.expr("transform(sequence(1, n_words - k + 1), i -> xxhash64(slice(words, i, k)))")
    rows = rows.withColumn("hashes", hashes).withColumn("item_key", F.xxhash64("item_id", "text"))
    return rows.select("item_id", "item_key", "n_words", "k", "hashes", simhash("hashes").alias("print"))


def clean_documents(documents: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that hold no benchmark item, with all their columns and repeated rows."""
    found = contaminated(documents, benchmark, **options).select("text_key").distinct()
    keyed = documents.withColumn("__text_key", F.md5(F.coalesce("text", F.lit(""))))
    return keyed.join(found, keyed["__text_key"] == found["text_key"], "left_anti").drop("__text_key")
