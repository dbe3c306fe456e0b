"""A blocked Bloom filter: all bits of a name lie in one block, so a probe is one joined row.

A block has `LANES` words of 64 bits, and a name sets one bit in each. The first base hash picks the block, six bits of the second for
each lane pick the bits. Blocks fill unevenly, which costs some size: about 10.1 bits per name for a rate of 1 %, where an unblocked filter takes 9.6.

`semi_join`, `anti_join` and `membership` use such a filter, small enough to be sent to all tasks, to decide most rows before
they are shuffled for the exact join. It may fill up without making an answer wrong.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postgrain import functions as fx
from postgrain.operators import bloom

HASH_VERSION = "blocked-1"
LANES, LANE_BITS = 8, 64
WORDS = [f"w{i}" for i in range(LANES)]
# Blocks of a filter that is sent to all tasks: 2**17 rows of 9 longs, under 10 MB, whatever the number of names.
SENT_BLOCKS = 1 << 17
# Terms of the sum over block sizes; a block of the default rate holds 51 names on average.
_SIZES = 400


def expected_rate(load: float) -> float:
    """False-positive rate with ``load`` names per block on average: block sizes are Poisson distributed."""
    share, rate = math.exp(-load), 0.0
    for names in range(1, _SIZES):
        share *= load / names
        rate += share * (1 - (1 - 1 / LANE_BITS) ** names) ** LANES
    return rate


def names_per_block(target: float) -> float:
    """The average load at which the expected rate is ``target``."""
    low, high = 0.0, float(LANES * LANE_BITS)
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if expected_rate(middle) < target else (low, middle)
    return low


def params(users: DataFrame, target: float = bloom.FALSE_POSITIVE_TARGET, most_blocks: int | None = None) -> DataFrame:
    """Names, blocks, bits and expected rate: one row. ``most_blocks`` bounds the size at the price of the rate."""
    blocks = F.greatest(F.lit(1).cast("bigint"), F.ceil(F.col("n") / names_per_block(target)))
    if most_blocks is not None:
        blocks = F.least(F.lit(most_blocks).cast("bigint"), blocks)
    load = F.col("n") / F.col("blocks")
    rate = F.aggregate(
        F.sequence(F.lit(1), F.lit(_SIZES - 1)),
        F.struct(F.exp(-load).alias("share"), F.lit(0.0).alias("rate")),
        lambda sum_, names: F.struct(
            (sum_["share"] * load / names).alias("share"),
            (sum_["rate"] + sum_["share"] * load / names * F.pow(1 - F.pow(F.lit(1 - 1 / LANE_BITS), names), F.lit(LANES))).alias("rate"),
        ),
        lambda sum_: sum_["rate"],
    )
    return users.agg(F.count(F.lit(1)).alias("n")).withColumn("blocks", blocks).select(
        "n", "blocks", (F.col("blocks") * LANES * LANE_BITS).alias("m"), F.lit(LANES).alias("k"),
        F.lit(target).alias("false_positive_target"), rate.alias("theoretical_fpr"), F.lit(HASH_VERSION).alias("hash_version"),
    )


def _lane(h2: Column, lane: int) -> Column:
    """The word of a lane with the name's bit set."""
    at = F.shiftright(h2, lane * 6).bitwiseAND(F.lit(LANE_BITS - 1).cast("bigint"))
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), at.cast("int"))


def placed(names: DataFrame, sizes: DataFrame, column: str = "username") -> DataFrame:
    """The rows with the ``block`` of their name and, as ``h2``, what picks the bits in it."""
    h1, h2 = fx.wide_hashes(F.col(column))
    return names.select("*", (h1 % sizes.select("blocks").scalar()).alias("block"), h2)


def build(users: DataFrame, sizes: DataFrame) -> DataFrame:
    """``(block, w0 ... w7)``, OR-ed in the map tasks; blocks without names are absent."""
    return placed(users.select("username"), sizes).groupBy("block").agg(
        *[F.bit_or(_lane(F.col("h2"), i)).alias(w) for i, w in enumerate(WORDS)]
    )


def _hit() -> Column:
    """Whether all bits of a row's name are set in the block joined to it; FALSE without a block."""
    hit = F.lit(True)
    for i, w in enumerate(WORDS):
        hit = hit & (F.col(w).bitwiseAND(_lane(F.col("h2"), i)) != 0)
    return F.coalesce(hit, F.lit(False))


def lookup(probes: DataFrame, blocks: DataFrame, sizes: DataFrame) -> DataFrame:
    """``(username, bloom_hit)`` for distinct probes; each is joined to its block, once."""
    joined = placed(probes.select("username"), sizes).join(blocks, "block", "left")
    return joined.select("username", _hit().alias("bloom_hit"))


def membership_verdicts(probes: DataFrame, blocks: DataFrame, sizes: DataFrame) -> DataFrame:
    verdict = F.when(F.col("bloom_hit"), F.lit(bloom.POSSIBLY_PRESENT)).otherwise(F.lit(bloom.DEFINITELY_ABSENT))
    return lookup(probes, blocks, sizes).select("username", verdict.alias("bloom_verdict"))


def evaluation(sizes: DataFrame, blocks: DataFrame, probe_set: DataFrame, data_source: str) -> DataFrame:
    """One row, as `bloom.bloom_evaluation` gives for the other filters."""
    found = lookup(probe_set.select("username").distinct(), blocks, sizes)
    return bloom.evaluation_row(probe_set.join(found, "username"), sizes, data_source)


def _checked(rows: DataFrame, column: str, users: DataFrame) -> DataFrame:
    """The rows with ``_hit``, decided in the map tasks by a filter of bounded size over ``users``."""
    sizes = params(users, most_blocks=SENT_BLOCKS)
    sent = F.broadcast(build(users, sizes))
    return placed(rows, sizes, column).join(sent, "block", "left").select(*rows.columns, _hit().alias("_hit"))


def semi_join(rows: DataFrame, users: DataFrame, column: str = "username") -> DataFrame:
    """The rows whose name is one of ``users``. Only those that pass the filter, hits and few others, reach the join."""
    passed = _checked(rows, column, users).filter("_hit").drop("_hit")
    return passed.join(users.select(F.col("username").alias(column)), column, "left_semi").select(*rows.columns)


def anti_join(rows: DataFrame, users: DataFrame, column: str = "username") -> DataFrame:
    """All other rows, those without a name too. What the filter rules out is not shuffled at all."""
    checked = _checked(rows, column, users)
    passed = checked.filter("_hit").drop("_hit")
    rest = passed.join(users.select(F.col("username").alias(column)), column, "left_anti").select(*rows.columns)
    return checked.filter("NOT _hit").drop("_hit").unionByName(rest)


def membership(probes: DataFrame, users: DataFrame) -> DataFrame:
    """``(username, exact_verdict)`` for distinct probes, as `bloom.exact_membership` gives."""
    checked = _checked(probes.select("username"), "username", users)
    passed = bloom.exact_membership(checked.filter("_hit").select("username"), users)
    absent = checked.filter("NOT _hit").select("username", F.lit(bloom.ABSENT).alias("exact_verdict"))
    return passed.unionByName(absent)
