"""Repeatable row samples.

A row is drawn by an MD5 of its own values and of its number among equal rows, so the
sample does not depend on the number of partitions, and copies are drawn one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, FloatType
from pyspark.sql.window import Window

from postgrain.schema import SAMPLE_OPTIONAL, SAMPLE_REQUIRED, present, user_column
from postgrain.sources import sinks

SAMPLE_FRACTION = 0.01

# Hex digits by which lowest_digests counts: at most 16**6 counters, and a whole table
# is cut to the sample and one part in 16**6.
PREFIX_DIGITS = 6

# Copies of a row that one array holds while they are drawn.
COPIES_AT_ONCE = 1000


def identity_of(posts: DataFrame) -> list[str]:
    """Post id, date and user, of those the frame has."""
    return present(posts, ["sid", "post_id", "date", "date_posted", user_column(posts)])


def _text(df: DataFrame, name: str) -> Column:
    """A value as text that other engines print alike."""
    fractional = isinstance(df.schema[name].dataType, (DoubleType, FloatType, DecimalType))
    col = F.col(name).cast("decimal(38,6)") if fractional else F.col(name)
    return col.cast("string")


def row_text(rows: DataFrame) -> Column:
    """All values of a row as one text; missing ones are left out."""
    return F.concat_ws("|", *[_text(rows, c) for c in rows.columns])


def _each_copy(rows: DataFrame, keep: Column | None = None) -> DataFrame:
    """The rows with ``_digest``, a row for each of its copies; only those ``keep`` accepts.

    Equal rows are counted in the map tasks and travel as one row and a number. Their copies are
    numbered in blocks, so a row that fills the table makes no array of its size.
    """
    columns = rows.columns
    counted = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    base = row_text(rows)
    last = F.floor((F.col("_n") - 1) / COPIES_AT_ONCE)
    blocks = counted.withColumn("_base", base).withColumn("_block", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    first = F.col("_block") * COPIES_AT_ONCE
    numbers = F.sequence(first, F.least(F.col("_n"), first + COPIES_AT_ONCE) - 1)
    digests = F.transform(numbers, lambda i: F.md5(F.concat_ws("|", F.col("_base"), i.cast("string"))))
    each = blocks.withColumn("_digest", F.explode(digests))
    return (each if keep is None else each.filter(keep)).select(*columns, "_digest")


def fraction_prefix(fraction: float) -> str:
    """Digests below this hex string make up the given share (under 1) of all digests."""
    return f"{int(fraction * 16**8):08x}"


def _cutoff(prefixes: DataFrame, cap: int) -> DataFrame:
    """The prefix up to which there are ``cap`` rows; none if there are fewer. Prefixes are counted in the map tasks."""
    running = Window.orderBy("prefix").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        prefixes.groupBy("prefix").agg(F.count(F.lit(1)).alias("n"))
        .withColumn("reached", F.sum("n").over(running))
        .filter((F.col("reached") >= cap) & (F.col("reached") - F.col("n") < cap))
        .select("prefix")
    )


def lowest_digests(rows: DataFrame, cap: int) -> DataFrame:
    """The ``cap`` rows with the smallest ``_digest``, or all rows if there are fewer.

    A plain ``orderBy().limit(cap)`` would send ``cap`` rows from every task to a single
    one. Here a first pass over the digest alone counts rows per digest prefix, combined in
    the map tasks, and finds the prefix up to which there are ``cap`` rows. Only the rows up
    to it are collected.
    """
    columns = [c for c in rows.columns if c != "_digest"]
    prefix = F.substring("_digest", 1, PREFIX_DIGITS)
    cutoff = _cutoff(rows.select(prefix.alias("prefix")), cap)
    # No cutoff means fewer rows than wanted: keep all of them.
    kept = rows.filter(F.coalesce(prefix <= cutoff.scalar(), F.lit(True)))
    return kept.orderBy("_digest", *columns).limit(cap).select(*columns)


def engagement_sample(
    posts: DataFrame,
    fraction: float = SAMPLE_FRACTION,
    cap: int | None = None,
    extra: tuple[str, ...] = (),
) -> DataFrame:
    """About one percent of the posts for scatter charts; at most ``cap`` rows if that is given.

    Rows that agree in post id, date, user and all sampled columns are copies of each other.
    """
    columns = [*SAMPLE_REQUIRED, *present(posts, SAMPLE_OPTIONAL), *extra]
    rows = posts.select(*dict.fromkeys([*identity_of(posts), *columns]))
    drawn = _each_copy(rows, F.col("_digest") < fraction_prefix(fraction) if fraction < 1 else None)
    if cap is not None:
        drawn = lowest_digests(drawn, cap)
    return drawn.select(*columns)


def _candidates(rows: DataFrame, cap: int) -> DataFrame:
    """The rows that can be among those of the ``cap`` smallest digests, and few others.

    Whole rows are wide, and most of them are not drawn, so the digests of first copies alone are shuffled and counted. Of these ``cap`` different ones
    bound the digests drawn. Beyond the bound only further copies can be drawn, so rows whose text recurs stay, however many they are. Rows are
    read once and written with their digest to the shared folder, and so are the digests that recur: Spark then knows how many they are.
    """
    spark, path = rows.sparkSession, sinks.shared_folder(rows.sparkSession, "row-sample")
    first = F.unhex(F.md5(F.concat_ws("|", row_text(rows), F.lit("0"))))
    keyed = sinks.stored(rows.withColumn("_first", first), f"{path}/rows")
    counted = sinks.stored(keyed.groupBy("_first").agg(F.count(F.lit(1)).alias("n")), f"{path}/counts")
    prefix = F.substring(F.lower(F.hex("_first")), 1, PREFIX_DIGITS)
    cutoff = _cutoff(counted.select(prefix.alias("prefix")), cap)
    again = sinks.stored(counted.filter("n > 1").select("_first", F.lit(True).alias("_again")), f"{path}/again")
    low = F.coalesce(prefix <= cutoff.scalar(), F.lit(True))
    found = keyed.join(again, "_first", "left").filter(low | F.col("_again"))
    return sinks.stored(found.select(*rows.columns), f"{path}/candidates")


def explorer_sample(posts: DataFrame, cap: int) -> DataFrame:
    """``cap`` whole rows, for a look at posts that are too many to page through."""
    return lowest_digests(_each_copy(_candidates(posts, cap)), cap)
