"""Overall summary and the roll-ups by one dimension.

All of them combine in the map tasks before the shuffle, so a group that holds most
of the rows costs one small row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postgrain.operators.quantiles import discrete_quantiles
from postgrain.schema import present, user_column

CONTENT_AVERAGES = [
    "likes", "comments", "engagement", "followers", "image_grade", "description_grade",
]
ACCOUNT_AVERAGES = ["likes", "comments", "engagement", "followers", "engagement_rate"]


def averages(df: DataFrame, metrics: list[str]) -> list[Column]:
    """``avg_<metric>`` for the metrics that exist; NULLs are skipped."""
    return [F.avg(c).alias(f"avg_{c}") for c in present(df, metrics)]


def by(df: DataFrame, keys: list[str], metrics: list[str]) -> DataFrame:
    """Post count and averages per key."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("post_count"), *averages(df, metrics)
    )


def _largest_first(df: DataFrame, *keys: str) -> DataFrame:
    return df.orderBy(F.col("post_count").desc(), *keys)


def medians(posts: DataFrame, exact: bool = False, accuracy: int = 10_000) -> DataFrame:
    """Median likes and comments, one row.

    By default the approximate percentile with its bounded sketch; ``exact`` ranks
    the distinct values instead.
    """
    metrics = present(posts, ["likes", "comments"])
    if exact:
        return discrete_quantiles(posts, metrics, 0.5, prefix="median_")
    return posts.agg(*[
        F.percentile_approx(c, 0.5, accuracy).alias(f"median_{c}") for c in metrics
    ])


SUMMARY_AVERAGES = ["likes", "comments", "followers", "engagement", "engagement_rate"]


def overall_counts(posts: DataFrame) -> DataFrame:
    """Totals, distinct users and averages, one row, from one read of the posts.

    Sums and counts are combined per user, in the map tasks first, and then over the users, so that
    users need no count of their own.
    """
    summed = present(posts, SUMMARY_AVERAGES)
    measures = [fn(c).alias(f"{fn.__name__}_{c}") for c in summed for fn in (F.sum, F.count)]
    flags = []
    if "is_business_account" in posts.columns:
        flag = F.col("is_business_account")
        measures += [F.count_if(flag).alias("business"), F.count_if(~flag).alias("other")]
        flags = [("business", "business_post_count"), ("other", "non_business_post_count")]
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    users = posts.groupBy(F.col(user_column(posts)).alias("user")).agg(F.count(F.lit(1)).alias("n"), *measures)
    return users.agg(
        total("n").alias("total_posts"),
        *[F.try_divide(F.sum(f"sum_{c}"), F.sum(f"count_{c}")).alias(f"avg_{c}") for c in summed],
        *[total(c).alias(name) for c, name in flags],
        F.count("user").alias("unique_users"),
    )


def overall_summary(posts: DataFrame, exact_medians: bool = False) -> DataFrame:
    """Counts, averages and medians side by side in one row; the medians are one subquery, with a narrow read of its own."""
    middle = medians(posts, exact=exact_medians)
    both = middle.select(F.struct(*middle.columns).alias("m")).scalar()
    return overall_counts(posts).withColumn("m", both).select("*", "m.*").drop("m")


def content_analysis(posts: DataFrame) -> DataFrame:
    keys = ["post_type", "post_type_label"]
    return _largest_first(by(posts, keys, CONTENT_AVERAGES), *keys)


def category_analysis(posts: DataFrame) -> DataFrame:
    keys = ["description_category"]
    return _largest_first(by(posts, keys, CONTENT_AVERAGES), *keys)


def business_analysis(posts: DataFrame) -> DataFrame:
    return by(posts, ["is_business_account"], ACCOUNT_AVERAGES)


def _by_calendar(posts: DataFrame, part: str, name: str, metrics: list[str]) -> DataFrame:
    return by(posts, [part], metrics).withColumnRenamed(part, name).orderBy(name)


def temporal_year(posts: DataFrame) -> DataFrame:
    return _by_calendar(posts, "post_year", "year", ["engagement", "likes"])


def temporal_month(posts: DataFrame, fill: bool = False) -> DataFrame:
    """Seasonality: all years pooled. ``fill`` adds months without posts as zero rows."""
    months = _by_calendar(posts, "post_month", "month", ["engagement"])
    if not fill:
        return months
    axis = posts.sparkSession.range(1, 13).select(F.col("id").cast("int").alias("month"))
    return (
        axis.join(months, "month", "left")
        .withColumn("post_count", F.coalesce("post_count", F.lit(0)))
        .orderBy("month")
    )


def temporal_weekday(posts: DataFrame) -> DataFrame:
    return _by_calendar(posts, "day_of_week", "weekday", ["engagement"])


def language_analysis(posts: DataFrame) -> DataFrame:
    return _largest_first(by(posts, ["lang"], []), "lang")


def _legacy_by(legacy: DataFrame, key: str) -> DataFrame:
    return legacy.groupBy(key).agg(
        F.count("engagement").alias("posts_count"),
        F.avg("engagement").alias("average_engagement"),
        F.sum("engagement").alias("total_engagement"),
    )


def legacy_content_analysis(legacy: DataFrame) -> DataFrame:
    return _legacy_by(legacy, "content_type")


def legacy_location_analysis(legacy: DataFrame) -> DataFrame:
    return _legacy_by(legacy, "location").orderBy(F.col("posts_count").desc(), "location")
