"""Top-k users and categories, globally and per slice. Ties go to the smaller name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from postgrain.schema import SLICE_DIMS, user_column

TOP_USERS = 15
TOP_CATEGORIES = 15
TOP_ENGAGING_CATEGORIES = 12

# Spark prunes a ranked window in the map tasks up to so many rows per group.
PRUNED_RANK = "spark.sql.optimizer.windowGroupLimitThreshold"
SALTS = 64


def top(df: DataFrame, by: str, k: int, tie: str = "username") -> DataFrame:
    """The k largest rows; every task keeps k rows and only those are merged."""
    return df.orderBy(F.col(by).desc_nulls_last(), tie).limit(k)


def user_totals(posts: DataFrame) -> DataFrame:
    """One row per user with every measure the rankings need.

    A ranking uses two or three of the measures and Catalyst drops the others.
    """
    have = set(posts.columns)
    measures = {
        "max_followers": ("followers", F.max),
        "total_likes": ("likes", F.sum),
        "total_engagement": ("engagement", F.sum),
        "avg_engagement": ("engagement", F.avg),
    }
    return posts.groupBy(F.col(user_column(posts)).alias("username")).agg(
        F.count(F.lit(1)).alias("post_count"),
        *[fn(c).alias(name) for name, (c, fn) in measures.items() if c in have],
    )


def top_users_by_posts(posts: DataFrame, k: int = TOP_USERS) -> DataFrame:
    return top(user_totals(posts).select("username", "post_count"), "post_count", k)


def top_users_by_followers(posts: DataFrame, k: int = TOP_USERS) -> DataFrame:
    users = user_totals(posts).select("username", "max_followers", "post_count")
    return top(users, "max_followers", k)


def top_users_by_likes(posts: DataFrame, k: int = TOP_USERS) -> DataFrame:
    users = user_totals(posts).select("username", "total_likes", "post_count")
    return top(users, "total_likes", k)


def top_users_by_engagement(posts: DataFrame, k: int = TOP_USERS) -> DataFrame:
    users = user_totals(posts).select(
        "username", "total_engagement", "avg_engagement", "post_count"
    )
    return top(users, "total_engagement", k)


def top_per_group(
    df: DataFrame, group: list[str], order: list[Column], spread: str, k: int, rank: str = "rn"
) -> DataFrame:
    """The first k rows of each group, numbered from 1.

    Up to the session's threshold Spark cuts every map task to k rows per group before the
    shuffle. Beyond it each group is first ranked in ``SALTS`` parts, chosen by the
    hash of ``spread``, so that no task sorts a whole group.
    """
    if k > int(df.sparkSession.conf.get(PRUNED_RANK)):
        part = F.pmod(F.xxhash64(spread), F.lit(SALTS))
        within = Window.partitionBy(*group, part).orderBy(*order)
        df = df.withColumn(rank, F.row_number().over(within)).filter(F.col(rank) <= k)
    within = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(within)).filter(F.col(rank) <= k)


def top_users_cube(posts: DataFrame, k: int = TOP_USERS) -> DataFrame:
    """The k users with the most engagement in each (type, business, category) cell."""
    cells = posts.groupBy(*SLICE_DIMS, F.col(user_column(posts)).alias("username")).agg(
        F.sum("engagement").alias("total_engagement"),
        F.count(F.lit(1)).alias("post_count"),
    )
    order = [F.col("total_engagement").desc(), F.col("username")]
    return top_per_group(cells, SLICE_DIMS, order, "username", k)


def top_categories(categories: DataFrame, k: int = TOP_CATEGORIES) -> DataFrame:
    """Largest categories of a category roll-up."""
    picked = categories.select("description_category", "post_count")
    return top(picked, "post_count", k, "description_category")


def most_engaging_categories(
    categories: DataFrame, k: int = TOP_ENGAGING_CATEGORIES
) -> DataFrame:
    """Categories of a category roll-up with the highest mean engagement."""
    picked = categories.select("description_category", "avg_engagement")
    return top(picked, "avg_engagement", k, "description_category")
