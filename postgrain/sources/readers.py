"""Scans: the Parquet posts, the legacy CSV, cleaned CSV and saved results."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Quotes are escaped by doubling, fields may hold line breaks, and bad rows are kept.
CSV_OPTIONS = {
    "header": "true", "multiLine": "true", "quote": '"', "escape": '"', "mode": "PERMISSIVE",
}


def read_posts(spark: SparkSession, path: str) -> DataFrame:
    """Primary posts. The file's own schema is kept, so 64-bit ids stay exact."""
    return spark.read.parquet(path)


def read_legacy_csv(
    spark: SparkSession, path: str, schema: StructType | str | None = None, multiline: bool = True
) -> DataFrame:
    """Legacy posts, every column a string.

    A file with line breaks inside fields cannot be split, so one task reads one
    file. Pass ``multiline=False`` for exports without them and Spark splits files.
    A ``schema`` saves the header pass.
    """
    reader = spark.read.options(**CSV_OPTIONS).option("multiLine", multiline)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", False)
    return reader.csv(path)


def read_clean_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A CSV that this package wrote, with its types given rather than guessed.

    Guessing would turn ids with leading zeros or more than 18 digits into numbers.
    """
    return spark.read.options(**CSV_OPTIONS).schema(schema).csv(path)


def open_posts(spark: SparkSession, primary: str, fallback: str) -> tuple[str, DataFrame]:
    """``("primary", posts)`` if the Parquet is there, else ``("fallback", posts)`` from CSV.

    The two are never mixed. If neither exists the error names the fallback path.
    """
    try:
        return "primary", read_posts(spark, primary)
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
    return "fallback", read_legacy_csv(spark, fallback)


def register_views(posts: DataFrame, *names: str) -> DataFrame:
    """Make ``posts`` available to ``spark.sql`` under the given names."""
    for name in names or ("posts",):
        posts.createOrReplaceTempView(name)
    return posts


def read_result(
    spark: SparkSession, path: str, schema: StructType | str | None = None
) -> DataFrame:
    """All part files of one saved result table."""
    reader = spark.read.options(**CSV_OPTIONS)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)
