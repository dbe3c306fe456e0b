"""Keeping stored posts, cube, user totals and Bloom filter up to date batch by batch, instead of writing all of them anew.

A batch rewrites the years that it touches: those of its posts, and those that hold a post with one of its ids, which may win or lose
against the new one. Cube and user totals are kept per year, so only these years are computed again, and every report adds up
years. Bloom words only gain bits, so those of the batch's new users are OR-ed in; when the users outgrow the filter's capacity, a power of
two, it is built anew from the stored users.

Each batch writes a generation of its own: the folders of the years it touched, and at last a manifest that says which generation
holds which year. Until the manifest is there the batch has not happened, so one that fails half way is run again, and readers see whole
generations. Years that lost all their posts are in no manifest.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postgrain import functions as fx
from postgrain.operators import blocked_bloom, bloom, cleaning, slices, topk
from postgrain.schema import SLICE_DIMS

# The year of posts without a readable date.
NO_YEAR = 0
LEAST_CAPACITY = 1 << 10


def _with_year(usable: DataFrame) -> DataFrame:
    year = F.year(fx.parse_post_timestamp(F.col("date")))
    return usable.withColumn("year", F.coalesce(year, F.lit(NO_YEAR)))


def manifest(spark: SparkSession, store: str) -> tuple[int, dict[int, int]]:
    """The newest generation, 0 if there is none, and the generation that holds each year: one row per year."""
    try:
        rows = spark.read.parquet(f"{store}/manifest")
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0, {}
    newest = rows.agg(F.max("generation")).first()[0]
    held = rows.filter(F.col("generation") == newest).select("year", "held_by").collect()
    return newest, {r["year"]: r["held_by"] for r in held if r["year"] is not None}


def read(spark: SparkSession, store: str, name: str, years: set[int] | None = None) -> DataFrame:
    """The current rows of a table that is kept by year; the filter names folders, so others are not read."""
    _, held = manifest(spark, store)
    wanted = [(F.col("generation") == g) & (F.col("year") == y) for y, g in held.items() if years is None or y in years]
    rows = spark.read.schema(spark.read.parquet(f"{store}/layout/{name}").schema).parquet(f"{store}/{name}")
    return rows.filter(reduce(lambda a, b: a | b, wanted, F.lit(False))).drop("generation")


def _write(rows: DataFrame, store: str, name: str, generation: int) -> DataFrame:
    """Writes the generation's folders of a table, and its columns where they can be read when there are no rows.

    The rows come out of a shuffle, of partitions that adaptive execution has sized; bringing the rows of a year together would shuffle them
    once more, to save files that are as many as these partitions for each year.
    """
    path = f"{store}/{name}/generation={generation}"
    rows.write.mode("overwrite").partitionBy("year").parquet(path)
    layout = rows.withColumn("generation", F.lit(generation))
    layout.limit(0).coalesce(1).write.mode("overwrite").parquet(f"{store}/layout/{name}")
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def apply_batch(spark: SparkSession, store: str, batch: DataFrame) -> int:
    """Takes a batch of raw posts in; returns its generation. Batches may be of any size and repeat ids of each other."""
    last, held = manifest(spark, store)
    generation = last + 1
    # Later steps read the batch several times.
    incoming = cleaning.usable_posts(batch)
    incoming.write.mode("overwrite").parquet(f"{store}/incoming/generation={generation}")
    incoming = _with_year(spark.read.schema(incoming.schema).parquet(f"{store}/incoming/generation={generation}"))
    touched = incoming.select("year")
    if held:
        stored = read(spark, store, "posts")
        touched = touched.unionByName(stored.join(incoming.select("sid"), "sid", "left_semi").select("year"))
    years = {r["year"] for r in touched.distinct().collect()}  # one row per year
    rows = incoming if not held else incoming.unionByName(read(spark, store, "posts", years).select(*incoming.columns))
    kept = cleaning.dedup_posts(rows.drop("year"))
    posts = _write(_with_year(kept), store, "posts", generation)
    clean = cleaning.with_derived_columns(posts)
    _write(slices.filter_cube(clean, "year"), store, "cube", generation)
    totals = clean.groupBy("year", *SLICE_DIMS, "username").agg(
        F.sum("engagement").alias("total_engagement"), F.count("engagement").alias("n_engagement"), F.count(F.lit(1)).alias("post_count"),
    )
    _write(totals, store, "users", generation)
    _grow_bloom(spark, store, incoming, last, generation)
    now = {r["year"]: generation for r in posts.select("year").distinct().collect()}
    now = {y: g for y, g in held.items() if y not in years} | now
    # One row without year when no posts are left, so that there is a manifest all the same.
    lines = [(generation, y, g) for y, g in now.items()] or [(generation, None, None)]
    spark.createDataFrame(lines, "generation int, year int, held_by int").coalesce(1).write.mode("append").parquet(f"{store}/manifest")
    return generation


def capacity_for(n: int) -> int:
    """The smallest power of two that holds ``n`` users."""
    return max(LEAST_CAPACITY, 1 << max(0, n - 1).bit_length())


def _sizes(spark: SparkSession, capacity: int) -> DataFrame:
    return blocked_bloom.params(spark.range(capacity).withColumnRenamed("id", "username"))


def _grow_bloom(spark: SparkSession, store: str, incoming: DataFrame, last: int, generation: int) -> None:
    path = f"{store}/bloom/generation={generation}"
    users = bloom.distinct_users(incoming)
    if last:
        known, sizes, words = load_bloom(spark, store, last)
        before = sizes.first()
        users = users.join(known, "username", "left_anti")
    # New users alone are added to the folder of users; a generation that did not come about is written over.
    users.write.mode("overwrite").parquet(f"{store}/bloom_users/generation={generation}")
    fresh = spark.read.schema("username string").parquet(f"{store}/bloom_users/generation={generation}")
    n = fresh.count() + (before["users"] if last else 0)
    capacity = capacity_for(n)
    sizes = _sizes(spark, capacity).withColumn("users", F.lit(n).cast("bigint")).withColumn("capacity", F.lit(capacity).cast("bigint"))
    sizes.coalesce(1).write.mode("overwrite").parquet(f"{path}/sizes")
    sizes = spark.read.parquet(f"{path}/sizes")
    if last and before["capacity"] == capacity:
        both = words.unionByName(blocked_bloom.build(fresh, sizes))
        words = both.groupBy("block").agg(*[F.bit_or(w).alias(w) for w in blocked_bloom.WORDS])
    else:
        words = blocked_bloom.build(known.unionByName(fresh) if last else fresh, sizes)
    words.write.mode("overwrite").parquet(f"{path}/words")


def load_bloom(spark: SparkSession, store: str, generation: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(users, sizes, blocks)`` of a generation, the newest unless one is given."""
    generation = generation if generation is not None else manifest(spark, store)[0]
    users = spark.read.schema("username string, generation int").parquet(f"{store}/bloom_users")
    path = f"{store}/bloom/generation={generation}"
    return users.filter(F.col("generation") <= generation).drop("generation"), spark.read.parquet(f"{path}/sizes"), spark.read.parquet(f"{path}/words")


def clean_posts(spark: SparkSession, store: str) -> DataFrame:
    """All current posts, as `cleaning.clean_posts` with de-duplication gives them."""
    return cleaning.with_derived_columns(read(spark, store, "posts").drop("year"))


def filter_cube(spark: SparkSession, store: str) -> DataFrame:
    return slices.merged_cube(read(spark, store, "cube").drop("year"))


def top_users(spark: SparkSession, store: str, selection: slices.Selection, k: int = topk.TOP_USERS) -> DataFrame:
    """The users with the most engagement in a selection, from the totals of all years."""
    rows = slices.select_slice(read(spark, store, "users"), selection)
    totals = rows.groupBy("username").agg(
        F.sum("total_engagement").alias("total_engagement"), F.sum("n_engagement").alias("n"), F.sum("post_count").alias("post_count"),
    )
    average = F.try_divide("total_engagement", "n").alias("avg_engagement")
    return topk.top(totals.select("username", "total_engagement", average, "post_count"), "total_engagement", k)
