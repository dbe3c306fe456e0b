"""A Bloom filter over user names that is built and queried as Spark jobs.

The bit array is a table ``(word, bits)`` of 64-bit words; words without a set bit
are absent. Nothing is collected: sizes travel as scalar subqueries.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postgrain import functions as fx
from postgrain.functions.hashing import WORD_BITS

# Version 1 has two base hashes of 31 bits, version 2 two of 60 bits, for filters of any size.
HASH_VERSION, WIDE_HASH_VERSION = "doublehash-1", "doublehash-2"

# Target rate and the bounds of array size and hash count.
FALSE_POSITIVE_TARGET = 0.01
MIN_BITS = 128
MIN_HASHES, MAX_HASHES = 2, 20

# The verdicts of a lookup.
POSSIBLY_PRESENT, DEFINITELY_ABSENT = "POSSIBLY PRESENT", "DEFINITELY ABSENT"
PRESENT, ABSENT = "PRESENT", "ABSENT"

# Sizes and spelling of the evaluation's negative probes.
FAR_PROBES, NEAR_PROBES = 500, 300
FAR_PREFIX = "not_a_real_user_"
MUTATION_ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789"


def distinct_users(posts: DataFrame, user: str = "username") -> DataFrame:
    """Distinct normalised user names, without NULL and empty ones."""
    name = fx.normalize_username(F.col(user))
    return posts.select(name.alias("username")).filter("username != ''").distinct()


def bloom_params(
    users: DataFrame, target: float = FALSE_POSITIVE_TARGET, version: str = HASH_VERSION
) -> DataFrame:
    """Number of users, bits and hash functions, and the expected rate: one row.

    ``version`` names the base hashes. Those of version 1 stop spreading once there are more than
    2**31 bits, some 220 million users; take version 2 for more.
    """
    ln2 = F.lit(math.log(2.0))
    n = F.col("n").cast("double")
    m = F.col("m").cast("double")
    best_m = F.ceil(-(n * F.ln(F.lit(target))) / (ln2 * ln2))
    # Without users the ratio has no value and any number of hashes will do.
    best_k = F.coalesce(F.bround(F.try_divide(m, n) * ln2), F.lit(MAX_HASHES))
    k = F.least(F.lit(MAX_HASHES), F.greatest(F.lit(MIN_HASHES), best_k)).cast("int")
    load = F.exp(-F.col("k") * n / m)
    return (
        users.agg(F.count(F.lit(1)).alias("n"))
        .withColumn("m", F.greatest(F.lit(MIN_BITS).cast("bigint"), best_m))
        .withColumn("k", k)
        .withColumn("false_positive_target", F.lit(target))
        .withColumn("theoretical_fpr", F.pow(1.0 - load, F.col("k")))
        .withColumn("hash_version", F.lit(version))
    )


def hashes(users: DataFrame, version: str = HASH_VERSION) -> DataFrame:
    """``username`` with its two base hashes."""
    if version == WIDE_HASH_VERSION:
        return users.select("username", *fx.wide_hashes(F.col("username")))
    points = users.select("username", fx.code_points(F.col("username")).alias("points"))
    return points.select(
        "username", fx.djb2(F.col("points")).alias("h1"), fx.sdbm(F.col("points")).alias("h2")
    )


def positions(hashed: DataFrame, params: DataFrame) -> DataFrame:
    """The k bit positions of each pair of base hashes: ``(h1 + i * h2) mod m``."""
    sized = hashed.select("h1", "h2").withColumns({
        "m": params.select("m").scalar(), "k": params.select("k").scalar(),
    })
    spread = sized.select("h1", "h2", "m", F.explode(
        F.sequence(F.lit(0), F.col("k") - 1)
    ).alias("i"))
    # Reduced before they are multiplied, so that 60-bit hashes do not overflow.
    place = (F.col("h1") % F.col("m") + F.col("i") * (F.col("h2") % F.col("m"))) % F.col("m")
    return spread.select("h1", "h2", place.alias("position"))


def word_of(position: Column) -> Column:
    return F.shiftright(position, int(math.log2(WORD_BITS)))


def bloom_words(
    users: DataFrame, params: DataFrame, version: str = HASH_VERSION
) -> DataFrame:
    """The bit array. Bits are OR-ed in the map tasks before the shuffle on ``word``."""
    at = F.col("position")
    return (
        positions(hashes(users, version), params)
        .groupBy(word_of(at).alias("word"))
        .agg(F.bit_or(fx.bit_mask(at)).alias("bits"))
    )


def distinct_probes(probes: DataFrame, column: str) -> DataFrame:
    """Probe names, normalised; each is looked up once however often it occurs."""
    return distinct_users(probes, column)


def bloom_lookup(
    probes: DataFrame, words: DataFrame, params: DataFrame, version: str = HASH_VERSION
) -> DataFrame:
    """``(username, bloom_hit)`` for distinct probes: are all of its k bits set?

    The verdict depends on the two base hashes alone, so only these go through the join with the
    bits, k times each, and not the names. It is an inner join: Spark may broadcast whichever side
    it measures as small, a short probe list or a small filter, and otherwise joins the
    two by shuffling on ``word``, by which the filter is already partitioned.
    """
    at = F.col("position")
    hashed = hashes(probes.select("username"), version)
    found = (
        positions(hashed.select("h1", "h2").distinct(), params)
        .withColumn("word", word_of(at))
        .join(words, "word")
        .filter(F.col("bits").bitwiseAND(fx.bit_mask(at)) != 0)
        .groupBy("h1", "h2")
        .agg(F.count(F.lit(1)).alias("bits_found"))
    )
    hit = F.coalesce(F.col("bits_found"), F.lit(0)) == params.select("k").scalar()
    return hashed.join(found, ["h1", "h2"], "left").select("username", hit.alias("bloom_hit"))


def exact_lookup(probes: DataFrame, users: DataFrame) -> DataFrame:
    """``(username, exact_hit)`` for distinct probes against the exact user set."""
    known = users.join(probes.select("username"), "username", "left_semi")
    return probes.join(known.withColumn("known", F.lit(True)), "username", "left").select(
        "username", F.coalesce(F.col("known"), F.lit(False)).alias("exact_hit")
    )


def bloom_membership(
    probes: DataFrame, words: DataFrame, params: DataFrame, version: str = HASH_VERSION
) -> DataFrame:
    verdict = F.when(F.col("bloom_hit"), F.lit(POSSIBLY_PRESENT)).otherwise(
        F.lit(DEFINITELY_ABSENT)
    )
    return bloom_lookup(probes, words, params, version).select(
        "username", verdict.alias("bloom_verdict")
    )


def exact_membership(probes: DataFrame, users: DataFrame) -> DataFrame:
    verdict = F.when(F.col("exact_hit"), F.lit(PRESENT)).otherwise(F.lit(ABSENT))
    return exact_lookup(probes, users).select("username", verdict.alias("exact_verdict"))


def _hex_number(digest: Column, start: int) -> Column:
    return F.conv(F.substring(digest, start, 4), 16, 10).cast("int")


def mutate_one_character(name: Column) -> Column:
    """The name with one character replaced; place and new character follow its MD5."""
    digest = F.md5(name)
    place = _hex_number(digest, 1) % F.length(name) + 1
    letter = F.substring(
        F.lit(MUTATION_ALPHABET), _hex_number(digest, 5) % len(MUTATION_ALPHABET) + 1, F.lit(1)
    )
    return F.overlay(name, letter, place, F.lit(1))


def bloom_probe_set(
    users: DataFrame, far_probes: int = FAR_PROBES, near_probes: int = NEAR_PROBES
) -> DataFrame:
    """``(username, probe_group)``: all known users, invented names and near misses.

    Names that are users are dropped from the two negative groups, which have as many rows as
    the arguments say at most; the user set is only filtered against these.
    """
    spark = users.sparkSession
    positive = users.select("username", F.lit("positive").alias("probe_group"))
    far = spark.range(1, far_probes + 1).select(
        F.concat(F.lit(FAR_PREFIX), F.col("id").cast("string")).alias("username"),
        F.lit("far_negative").alias("probe_group"),
    )
    seeds = users.orderBy(F.md5(F.concat(F.lit("near"), "username")), "username")
    near = (
        seeds.limit(near_probes)
        .select(mutate_one_character(F.col("username")).alias("username"))
        .distinct()
        .withColumn("probe_group", F.lit("near_miss"))
    )
    negative = far.unionByName(near)
    known = users.join(F.broadcast(negative.select("username")), "username", "left_semi")
    return positive.unionByName(negative.join(F.broadcast(known), "username", "left_anti"))


def bloom_evaluation(
    params: DataFrame, words: DataFrame, probe_set: DataFrame, data_source: str,
    version: str = HASH_VERSION,
) -> DataFrame:
    """One row: sizes, false negatives, and false positives of both negative groups.

    ``negative_*`` counts the invented names, ``near_*`` the one-character mutations.
    """
    found = bloom_lookup(probe_set.select("username").distinct(), words, params, version)
    return evaluation_row(probe_set.join(found, "username"), params, data_source)


def evaluation_row(checked: DataFrame, params: DataFrame, data_source: str) -> DataFrame:
    """The row of an evaluation, from probes with ``probe_group`` and ``bloom_hit``."""
    group, hit = F.col("probe_group"), F.col("bloom_hit")
    tally = checked.agg(
        F.count_if(group == "positive").alias("positive_queries"),
        F.count_if((group == "positive") & ~hit).alias("positive_false_negatives"),
        F.count_if(group == "far_negative").alias("negative_queries"),
        F.count_if((group == "far_negative") & hit).alias("false_positives"),
        F.count_if(group == "near_miss").alias("near_queries"),
        F.count_if((group == "near_miss") & hit).alias("near_false_positives"),
    )
    names = {
        "inserted_users": "n", "bit_array_size": "m", "hash_functions": "k",
        "hash_version": "hash_version", "false_positive_target": "false_positive_target",
        "theoretical_fpr": "theoretical_fpr",
    }
    return tally.select(
        F.lit(data_source).alias("data_source"),
        *[params.select(src).scalar().alias(name) for name, src in names.items()],
        "*",
        F.try_divide("false_positives", "negative_queries").alias("false_positive_rate"),
        F.try_divide("near_false_positives", "near_queries").alias("near_false_positive_rate"),
    )
