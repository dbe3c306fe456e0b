"""Top users of any selection from stored totals, without reading the posts.

Totals are kept per user and cell of the filter cube, as lists by engagement: partitioned by `band`, four to each power of two, so that a scan
reads the upper part of all lists and no more, and with the first `HEAD` of each list apart. A query is a threshold algorithm of three steps:

1. the heads of the selection's lists give each user seen there a lower bound of their total; the k-th largest of these is the floor;
2. a user of the top k has at least floor / cells in one of the lists, so the lists are read down to that and no deeper;
3. the users found there, and they alone, are summed over all lists of the selection.

That is exact for every selection. The three steps are one lazy plan; floor and depth travel as scalar subqueries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postgrain.operators import topk
from postgrain.operators.slices import Selection, select_slice
from postgrain.schema import SLICE_DIMS, present, user_column

HEAD = 100
BANDS_PER_DOUBLING = 4
# Bands of totals below zero, and of those that are zero or missing.
NEGATIVE, NOTHING = -2, -1


def band(total: Column) -> Column:
    """The part of a list that a total lies in; a larger total is never in a smaller band."""
    above = F.floor(F.log2(total) * BANDS_PER_DOUBLING).cast("int")
    return F.when(total < 0, NEGATIVE).when(total > 0, F.greatest(F.lit(0), above)).otherwise(NOTHING)


def user_cells(posts: DataFrame) -> DataFrame:
    """Totals per user and cell, with their band."""
    cells = posts.groupBy(*present(posts, SLICE_DIMS), F.col(user_column(posts)).alias("username")).agg(
        F.sum("engagement").alias("total_engagement"),
        F.count("engagement").alias("n_engagement"),
        F.count(F.lit(1)).alias("post_count"),
    )
    return cells.withColumn("band", band(F.col("total_engagement")))


def save_lists(posts: DataFrame, path: str, head: int = HEAD) -> None:
    """The lists and their heads. Heads come from the stored lists, cut to ``head`` rows per cell in the map tasks."""
    spark, totals = posts.sparkSession, user_cells(posts)
    totals.hint("rebalance", "band").write.mode("overwrite").partitionBy("band").parquet(f"{path}/lists")
    lists = spark.read.schema(totals.schema).parquet(f"{path}/lists")
    dims = present(lists, SLICE_DIMS)
    order = [F.col("total_engagement").desc(), F.col("username")]
    best = topk.top_per_group(lists.filter(F.col("total_engagement") > 0), dims, order, "username", head)
    best.select(*totals.columns).write.mode("overwrite").parquet(f"{path}/heads")
    lists.groupBy(*dims).agg(F.count(F.lit(1)).alias("users")).write.mode("overwrite").parquet(f"{path}/cells")


def load_lists(spark: SparkSession, path: str) -> tuple[DataFrame, tuple[DataFrame, DataFrame]]:
    """``(lists, (heads, cells))`` as `save_lists` wrote them."""
    heads = spark.read.parquet(f"{path}/heads")
    lists = spark.read.schema(heads.schema).parquet(f"{path}/lists")
    return lists, (heads, spark.read.parquet(f"{path}/cells"))


def depth(lists: DataFrame, heads: tuple[DataFrame, DataFrame], selection: Selection, k: int) -> DataFrame:
    """How deep the lists must be read, one row: ``cut``, the least total that matters, or NULL if all do.

    Totals below zero would make a sum over heads no lower bound, so those that a user has are always added to it; as a band of their own they
    cost nothing where there are none.
    """
    best, cells = (select_slice(t, selection) for t in heads)
    below = select_slice(lists.filter(F.col("band") == NEGATIVE), selection)
    columns = ["username", "total_engagement"]
    seen = best.select(*columns).unionByName(below.select(*columns)).groupBy("username").agg(F.sum("total_engagement").alias("least"))
    floor = topk.top(seen, "least", k).agg(F.when(F.count(F.lit(1)) == k, F.min("least")).alias("floor"))
    n = cells.agg(F.count(F.lit(1)))
    return floor.select(F.when(F.col("floor") > 0, F.try_divide(F.col("floor"), n.scalar())).alias("cut"))


def candidates(lists: DataFrame, heads: tuple[DataFrame, DataFrame], selection: Selection, k: int) -> DataFrame:
    """Users who can be among the k with the most engagement: all with a total of at least the cut in some list."""
    cut = depth(lists, heads, selection, k)
    least_band = cut.select(F.coalesce(F.when(F.col("cut").isNotNull(), band(F.col("cut"))), F.lit(NEGATIVE)).alias("band"))
    everything = F.lit(float("-inf"))
    lowest = cut.select(F.coalesce("cut", everything).alias("cut")).scalar()
    upper = lists.filter(F.col("band") >= least_band.scalar())
    rows = select_slice(upper, selection).filter(F.coalesce("total_engagement", everything) >= lowest)
    return rows.select("username").distinct()


def top_users(
    lists: DataFrame, heads: tuple[DataFrame, DataFrame], selection: Selection, k: int = topk.TOP_USERS
) -> DataFrame:
    """The k users with the most engagement in a selection, as `slices.slice_top_users` finds them over the posts."""
    found = candidates(lists, heads, selection, k)
    totals = select_slice(lists, selection).join(found, "username", "left_semi").groupBy("username").agg(
        F.sum("total_engagement").alias("total_engagement"),
        F.sum("n_engagement").alias("n"),
        F.sum("post_count").alias("post_count"),
    )
    average = F.try_divide("total_engagement", "n").alias("avg_engagement")
    return topk.top(totals.select("username", "total_engagement", average, "post_count"), "total_engagement", k)
