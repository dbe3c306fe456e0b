"""The data behind the charts. Scatter charts take a sample, all others the posts or their roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postgrain import functions as fx

# Fixed value: number of grade bins.
GRADE_BINS = 10


def business_engagement(accounts: DataFrame) -> DataFrame:
    """Mean engagement by account label, from the business roll-up."""
    account = fx.account_label(F.col("is_business_account")).alias("account")
    return accounts.select(account, "avg_engagement").orderBy("account")


def posts_by_type(content: DataFrame) -> DataFrame:
    """Posts per type label, from the content roll-up."""
    return (
        content.groupBy("post_type_label").agg(F.sum("post_count").alias("post_count"))
        .orderBy("post_type_label")
    )


def followers_vs_likes(sample: DataFrame) -> DataFrame:
    """Scatter points on log axes; posts without likes sit at 0."""
    kept = sample.filter((F.col("followers") > 0) & (F.col("likes") >= 0))
    return kept.select(
        "followers", "likes",
        F.log10("followers").alias("log_followers"),
        F.log10(F.col("likes") + 1).alias("log_likes"),
    )


def followers_vs_engagement(sample: DataFrame) -> DataFrame:
    kept = sample.filter(F.col("followers") > 0)
    return kept.select(
        "followers", "engagement",
        F.log10("followers").alias("log_followers"),
        F.log10(F.col("engagement") + 1).alias("log_engagement"),
    )


def grade_bins(
    posts: DataFrame, grade: str, bins: int = GRADE_BINS, min_rows: int = 0
) -> DataFrame:
    """Mean likes per equal-width grade bin, as ``(bin, upper_edge, post_count, mean_likes)``.

    Bins are closed on the right; the first also holds the minimum. Empty bins are left
    out; with fewer than ``min_rows`` rows, if that is asked for, there is no output. If all grades are
    equal they share the middle bin.
    """
    rows = posts.filter(F.col(grade).isNotNull() & (F.col("likes") >= 0)).select(
        F.col(grade).cast("double").alias("grade"), "likes"
    )
    span = rows.agg(
        F.min("grade").alias("lo"), F.max("grade").alias("hi"), F.count(F.lit(1)).alias("n")
    )
    lo, hi = F.col("lo"), F.col("hi")

    def edge(i: int):
        return lo + F.lit(float(i)) * ((hi - lo) / bins)

    above = sum((F.col("grade") > edge(i)).cast("int") for i in range(1, bins))
    placed = (
        rows.withColumns({c: span.select(c).scalar() for c in span.columns})
        .filter(F.col("n") >= min_rows)
        .withColumn("bin", F.when(hi > lo, above + 1).otherwise(F.lit(bins // 2)))
    )
    return (
        placed.groupBy("bin", "lo", "hi")
        .agg(F.count(F.lit(1)).alias("post_count"), F.avg("likes").alias("mean_likes"))
        .select(
            "bin",
            F.when(F.col("bin") == bins, hi)
            .otherwise(lo + F.col("bin") * ((hi - lo) / bins)).alias("upper_edge"),
            "post_count", "mean_likes",
        )
        .orderBy("bin")
    )
