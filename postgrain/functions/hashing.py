"""Hashes as native expressions: no Python runs on the executors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Seeds, multipliers and modulus of the two base hashes.
HASH_MODULUS = 2147483647
DJB2_SEED, DJB2_FACTOR = 5381, 33
SDBM_SEED, SDBM_FACTOR = 0, 65599

WORD_BITS = 64


def code_points(text: Column) -> Column:
    """Unicode code points of a string as ``array<bigint>``."""
    chars = F.filter(F.split(text, ""), lambda c: c != "")
    return F.transform(chars, lambda c: F.ascii(c).cast("bigint"))


def _polynomial(points: Column, seed: int, factor: int) -> Column:
    # Values stay below 2**31 * 65599 + 2**21 < 2**48, so BIGINT arithmetic is exact.
    return F.aggregate(
        points,
        F.lit(seed).cast("bigint"),
        lambda h, v: (h * F.lit(factor).cast("bigint") + v) % F.lit(HASH_MODULUS).cast("bigint"),
    )


def djb2(points: Column) -> Column:
    """First base hash over code points."""
    return _polynomial(points, DJB2_SEED, DJB2_FACTOR)


def sdbm(points: Column) -> Column:
    """Second base hash over code points; never 0, since it is used as a stride."""
    return F.greatest(F.lit(1).cast("bigint"), _polynomial(points, SDBM_SEED, SDBM_FACTOR))


def wide_hashes(text: Column) -> list[Column]:
    """Two base hashes of 60 bits, ``h1`` and ``h2``, from the MD5; the second is never 0."""
    digest = F.md5(text)
    part = lambda start: F.conv(F.substring(digest, start, 15), 16, 10).cast("bigint")
    return [part(1).alias("h1"), F.greatest(F.lit(1).cast("bigint"), part(16)).alias("h2")]


def bit_mask(position: Column) -> Column:
    """64-bit word with the single bit ``position mod 64`` set."""
    return F.call_function(
        "shiftleft", F.lit(1).cast("bigint"), (position % WORD_BITS).cast("int")
    )
