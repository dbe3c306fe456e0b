"""Sinks: CSV directories, the cleaned Parquet table, result tables, Bloom tables."""

from __future__ import annotations

import logging
import tempfile
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

# Leading and trailing blanks are data (a blank location is cleaned later), so keep them.
CSV_WRITE_OPTIONS = {
    "header": "true", "quote": '"', "escape": '"',
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below the cluster's ``spark.checkpoint.dir``.

    Only a local session may leave that unset; it then gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        base = tempfile.mkdtemp(prefix="postgrain-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def write_csv(df: DataFrame, path: str) -> None:
    """CSV directory with headers, one file per partition, replacing an older one."""
    df.write.mode("overwrite").options(**CSV_WRITE_OPTIONS).csv(path)


def save_clean_posts(df: DataFrame, path: str) -> None:
    """Cleaned posts as Parquet, one folder per year.

    Every task writes its rows into the years it holds, so a year that holds much of the data is written by
    many tasks. Bringing years together first would shuffle whole posts, for fewer files alone.
    """
    writer = df.write.mode("overwrite")
    (writer.partitionBy("post_year") if "post_year" in df.columns else writer).parquet(path)


def save_result(df: DataFrame, out_dir: str, name: str) -> int:
    """Write a result table as CSV and return its row count.

    The table keeps its partitions: an ordered one is written as files that follow each other in
    order, by name. Adaptive execution merges the partitions of a small table into one file.
    """
    seen = Observation(f"{name}-{uuid.uuid4().hex}")
    started = time.monotonic()
    counted = df.observe(seen, F.count(F.lit(1)).alias("n"))
    write_csv(counted, f"{out_dir}/{name}")
    n = int(seen.get["n"])
    log.info("result %s: %d rows in %.1f s", name, n, time.monotonic() - started)
    return n


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write a frame as Parquet and re-open it, so that what follows starts from the files."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def save_bloom(
    users: DataFrame,
    path: str,
    make_params: Callable[[DataFrame], DataFrame],
    make_words: Callable[[DataFrame, DataFrame], DataFrame],
) -> None:
    """The three Bloom tables: exact user set, one parameter row, 64-bit words.

    Each is built from the stored one before it, so the users are computed once.
    """
    users = stored(users, f"{path}/bloom_users")
    params = stored(make_params(users), f"{path}/bloom_params")
    stored(make_words(users, params), f"{path}/bloom_words")


def load_bloom(
    spark: SparkSession, path: str, version: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(users, params, words)``; refuses tables built with other hash functions."""
    params = spark.read.parquet(f"{path}/bloom_params")
    found = params.select("hash_version").first()
    if found is None or found["hash_version"] != version:
        raise ValueError(f"Bloom tables at {path} are {found}, expected version {version}")
    return (
        spark.read.parquet(f"{path}/bloom_users"),
        params,
        spark.read.parquet(f"{path}/bloom_words"),
    )
