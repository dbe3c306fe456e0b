"""Exact quantiles without gathering the values in one task."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

HISTOGRAM_BUCKETS = 65_536


def _rank_reached(count: Column, metric: str, order: str) -> Column:
    """Running count within a metric, ordered by ``order``."""
    w = Window.partitionBy(metric).orderBy(order)
    return F.sum(count).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))


def value_counts(df: DataFrame, metrics: list[str]) -> DataFrame:
    """``(metric, value, n)``: how often each value occurs, counted in the map tasks first."""
    return (
        df.select(*[F.col(c).cast("double").alias(c) for c in metrics])
        .unpivot([], metrics, "metric", "value")
        .filter(F.col("value").isNotNull())
        .groupBy("metric", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _narrowed(left: DataFrame, scale: Callable[[Column], Column], buckets: int) -> DataFrame:
    """The values in the one of ``buckets`` equal buckets, on a scale, that holds the wanted rank; rank within it."""
    at = scale(F.col("value"))
    spans = left.groupBy("metric").agg(F.min(at).alias("lo"), F.max(at).alias("hi"))
    width = F.col("hi") - F.col("lo")
    bucket = F.when(width > 0, F.least(
        F.floor((at - F.col("lo")) / width * buckets), F.lit(buckets - 1)
    )).otherwise(F.lit(0))
    # One row per metric on the right-hand side, here and below.
    placed = left.join(F.broadcast(spans), "metric").withColumn("bucket", bucket)
    target = (
        placed.groupBy("metric", "bucket", "rank").agg(F.sum("n").alias("n"))
        .withColumn("reached", _rank_reached(F.col("n"), "metric", "bucket"))
        .filter((F.col("reached") >= F.col("rank")) & (F.col("reached") - F.col("n") < F.col("rank")))
        .select("metric", "bucket", (F.col("reached") - F.col("n")).alias("before"))
    )
    return placed.join(F.broadcast(target), ["metric", "bucket"]).select(
        "metric", "value", "n", (F.col("rank") - F.col("before")).alias("rank")
    )


def discrete_quantiles(
    df: DataFrame,
    metrics: list[str],
    q: float,
    prefix: str = "",
    buckets: int = HISTOGRAM_BUCKETS,
) -> DataFrame:
    """The smallest value of each metric whose cumulative share reaches ``q``, one row.

    Twice, the values fall into buckets, and a running count over at most ``buckets`` rows per metric
    finds the bucket that holds the wanted rank. The first buckets are equal on the scale of the inverse
    hyperbolic sine, so that a few huge values do not push all others into one; the second are
    equal between the smallest and the largest value left. Only what is then left is ranked.
    All steps share the shuffle that counts equal values.
    """
    counts = value_counts(df, metrics)
    ranks = counts.groupBy("metric").agg(
        F.greatest(F.lit(1), F.ceil(F.sum("n") * F.lit(q))).alias("rank")
    )
    left = counts.join(F.broadcast(ranks), "metric")
    left = _narrowed(_narrowed(left, F.asinh, buckets), lambda v: v, buckets)
    values = left.withColumn("reached", _rank_reached(F.col("n"), "metric", "value")).filter(
        F.col("reached") >= F.col("rank")
    )
    return values.agg(*[
        F.min(F.when(F.col("metric") == c, F.col("value"))).alias(f"{prefix}{c}") for c in metrics
    ])
