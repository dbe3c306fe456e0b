"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame and SQL functions only.

A source's target divided by its size is the number of copies each of its documents should have; the whole part is
certain, the fraction is a probability. Pairs of documents of a source transfer probability, weighted by their sizes, at random until one of
the two is 0 or 1: each document keeps its expectation, and the words of the source do not move at all. What stays fractional of a
block goes to the next level of a reduction tree over hash prefixes, up to one document for each source, which is drawn. The words taken
of a source therefore miss its target by less than one of its documents.

Random numbers are hashes of the documents paired, so reruns agree.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from postgrain.llm.store import stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1.0, 2.0, 3.0)
# No source may be repeated more often than this.
MOST_COPIES = 3
# Documents that one step of the reduction tree rounds together, on average.
BLOCK = 128


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """source, source_size, target: one row per source in ``sizes`` (source, size, rows).

    Sources by code point, NULL last, weigh ``weights``, repeating, and share the total; a target stops at ``most`` times the
    source's size, and the others share the rest by weight. Solved in one go: with sources by limit over weight, the share
    per weight is the first that stays below its source's limit, which is also the largest that does. One row per source goes through one task.
    """
    total = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"))
    ranked = total.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*map(F.lit, map(float, weights))), (F.col("rank") % len(weights) + 1).cast("int"))
    limits = ranked.withColumn("weight", weight).withColumn("limit", most * F.col("source_size").cast("double"))
    by_ratio = Window.orderBy(F.col("limit") / F.col("weight"), "rank")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(0))
    share = (F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum("weight").over(onward)
    return (
        limits.withColumn("share", share)
        .withColumn("level", F.max(F.when(F.col("share") * F.col("weight") <= F.col("limit"), F.col("share"))).over(everything))
        .select("source", "source_size", F.least("limit", F.col("level") * F.col("weight")).alias("target"))
    )


def _rounded(items: str, unit: str) -> str:
    """SQL: fold an array of (h, d, z, w, p) by pivotal steps into what is held and what is decided."""
    held = lambda s, p, out: f"named_struct('some', true, 'u', {s}.u, 'w', {s}.w, 'p', {p}, 'out', {out})"
    with_ = lambda s, k: f"concat(a.out, array(named_struct('u', {s}.u, 'extra', {k})))"
    return f"""
    aggregate({items},
      named_struct('some', false, 'u', cast(null as {unit}), 'w', 0.0D, 'p', 0.0D, 'out', cast(array() as array<struct<u:{unit},extra:bigint>>)),
      (a, x) -> if(not a.some, {held('x', 'x.p', 'a.out')},
        transform(array(named_struct(
          'up', least((1.0D - a.p) * a.w, x.p * x.w), 'down', least(a.p * a.w, (1.0D - x.p) * x.w),
          'r', (xxhash64(a.u, x.u, 'pair') & 9007199254740991L) / 9007199254740992.0D)), m ->
          if(m.r * (m.up + m.down) < m.down,
            if((1.0D - a.p) * a.w <= x.p * x.w,
              {held('x', 'greatest(x.p - m.up / x.w, 0.0D)', with_('a', '1L'))},
              {held('a', 'least(a.p + m.up / a.w, 1.0D)', with_('x', '0L'))}),
            if(a.p * a.w <= (1.0D - x.p) * x.w,
              {held('x', 'least(x.p + m.down / x.w, 1.0D)', with_('a', '0L'))},
              {held('a', 'greatest(a.p - m.down / a.w, 0.0D)', with_('x', '1L'))})))[0]))"""


def planned(documents: DataFrame, *, key: str = "doc_id", weights: tuple[float, ...] = WEIGHTS, block: int = BLOCK) -> DataFrame:
    """One row for equal rows (same key, source and size): key, source, size, rows, source_size, target, whole, extras.

    Each row is taken ``whole`` times and ``extras`` of the rows once more. Of the extras of equal rows all but a fraction of one is certain, so that
    only the fraction is rounded, with the words of one row.
    """
    sized = documents.select(F.col(key).alias("key"), F.col("source"), word_count(F.col("text")).alias("size"))
    units = stored(sized.groupBy("key", "source", "size").agg(F.count(F.lit(1)).alias("rows")), "mix-units")
    targets = stored(source_targets(units, weights), "mix-targets")
    of = targets.select(F.col("source").alias("of"), "source_size", "target")
    copies = F.when(F.col("size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    each = F.when(F.col("whole") < MOST_COPIES, copies - F.col("whole")).otherwise(0.0)
    shares = (
        units.join(of, units["source"].eqNullSafe(of["of"])).drop("of")
        .withColumn("whole", F.floor(copies))
        .withColumn("certain", F.floor(each * F.col("rows")))
        .withColumn("p", each * F.col("rows") - F.col("certain"))
        .withColumn("u", F.struct("key", "size"))
    )
    extra = _round(shares.where(F.col("p") > 0), block)
    e = extra.select(F.col("source").alias("e_source"), "u.key", "u.size", "extra").withColumnsRenamed({"key": "e_key", "size": "e_size"})
    same = shares["key"].eqNullSafe(e["e_key"]) & shares["source"].eqNullSafe(e["e_source"]) & (shares["size"] == e["e_size"])
    extras = (F.col("certain") + F.coalesce("extra", F.lit(0))).alias("extras")
    return shares.join(e, same, "left").select("key", "source", "size", "rows", "source_size", "target", "whole", extras)


def mix(documents: DataFrame, *, key: str = "doc_id", **options) -> DataFrame:
    """One row per document: key, source, size, source_size, target, copies, taken.

    ``copies`` is how often the mix takes the document, ``taken`` the words that makes. Repeated rows (same key, source and size) are
    taken row by row. NULL text has size 0 and no copy; so has a source without words, whose
    target is 0. NULL keys and sources are values like others. Only key, text and source are read; an empty table gives an empty result.
    """
    counted = planned(documents, key=key, **options)
    # As many rows as came in, in two steps, since one array for a document that fills the table could be too long.
    many = counted.withColumn("thousand", F.explode(F.sequence(F.lit(0).cast("long"), F.expr("(rows - 1) div 1000"))))
    each = many.withColumn("one", F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.lit(1000), F.col("rows") - 1000 * F.col("thousand")))))
    one_more = (F.col("thousand") * 1000 + F.col("one") <= F.col("extras")).cast("long")
    each = each.withColumn("copies", F.col("whole") + one_more)
    return each.select(
        F.col("key").alias(key), "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken")
    )


def _round(shares: DataFrame, block: int) -> DataFrame:
    """source, u, extra (0 or 1) for units (source, u, p, size) with a fraction p, level after level."""
    bits = max(0, math.ceil(math.log2(max(1, shares.count()) / block)))
    unit = shares.schema["u"].dataType.simpleString()
    level = shares.select(
        "source", "u", F.xxhash64("u", "source").alias("h"), F.col("p"), F.col("size").cast("double").alias("w")
    )
    step = max(1, int(math.log2(block)))
    decided = None
    while True:
        prefix = F.shiftrightunsigned("h", 64 - bits) if bits else F.lit(0).cast("long")
        items = F.sort_array(F.collect_list(F.struct("h", "u", "w", "p")))
        folded = level.groupBy("source", prefix.alias("prefix")).agg(items.alias("items")).select("source", F.expr(_rounded("items", unit)).alias("f"))
        folded = stored(folded, "mix-level")
        out = folded.select("source", F.explode("f.out").alias("o")).select("source", "o.u", "o.extra")
        decided = out if decided is None else decided.unionByName(out)
        if not bits:
            drawn = (F.xxhash64("f.u", F.lit("last")).bitwiseAND(F.lit(2**53 - 1)) / F.lit(float(2**53)) < F.col("f.p")).cast("long")
            return decided.unionByName(folded.select("source", F.col("f.u").alias("u"), drawn.alias("extra")))
        level = folded.select("source", "f.u", F.xxhash64("f.u", "source").alias("h"), "f.p", "f.w")
        bits = max(0, bits - step)


def mixed_documents(documents: DataFrame, **options) -> DataFrame:
    """The documents with each row as often as the mix takes it, with the columns they came with.

    Equal rows that are not all taken alike are numbered within the parts that they are read in, and parts by how many came before, so that a document
    that fills the table is numbered by many tasks. ``documents`` should be stored files, which are read in the same parts again.
    """
    own = documents.columns
    at = F.monotonically_increasing_id()
    sized = documents.withColumn("__size", word_count(F.col("text"))).withColumn("__at", at).withColumn("__part", F.shiftright("__at", 33))
    names = {"key": "__id", "source": "__source", "size": "__n", "rows": "__rows", "whole": "__whole", "extras": "__extras"}
    plan = planned(documents, **options).select(*[F.col(c).alias(n) for c, n in names.items()])
    same = sized["doc_id"].eqNullSafe(plan["__id"]) & sized["source"].eqNullSafe(plan["__source"]) & (sized["__size"] == plan["__n"])
    rows = sized.join(plan, same)
    uneven = (F.col("__extras") > 0) & (F.col("__extras") < F.col("__rows"))
    even = rows.where(~uneven).withColumn("__copies", F.col("__whole") + (F.col("__extras") > 0).cast("long"))
    unit = ["__id", "__source", "__n"]
    some = rows.where(uneven).withColumn("__i", F.row_number().over(Window.partitionBy(*unit, "__part").orderBy("__at")))
    before = Window.partitionBy(*unit).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sized.join(plan.where(uneven), same).groupBy(*unit, "__part").agg(F.count(F.lit(1)).alias("__in"))
    parts = parts.select(
        *[F.col(c).alias(f"{c}_") for c in (*unit, "__part")], F.coalesce(F.sum("__in").over(before), F.lit(0)).alias("__before")
    )
    there = (some["__part"] == parts["__part_"]) & (some["__n"] == parts["__n_"])
    there = there & some["__id"].eqNullSafe(parts["__id_"]) & some["__source"].eqNullSafe(parts["__source_"])
    one_more = (F.col("__before") + F.col("__i") <= F.col("__extras")).cast("long")
    odd = some.join(parts, there).withColumn("__copies", F.col("__whole") + one_more)
    kept = even.select(*[F.col(f"`{c}`") for c in own], "__copies").unionByName(odd.select(*[F.col(f"`{c}`") for c in own], "__copies"))
    kept = kept.where(F.col("__copies") > 0)
    return kept.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies")))).select(*[F.col(f"`{c}`") for c in own])
