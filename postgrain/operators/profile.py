"""Row counts, null counts and bounded previews."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postgrain.schema import QUALITY_COLUMNS, present, user_column


def overview(df: DataFrame) -> DataFrame:
    """Row count, column count and distinct users, one row. Users are counted as stored; a missing one is a value."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.lit(len(df.columns)).alias("column_count"),
        (
            F.count_distinct(user_column(df))
            + F.coalesce(F.max(F.col(user_column(df)).isNull().cast("int")), F.lit(0))
        ).alias("distinct_usernames"),
    )


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """``null_<column>`` for each given column that exists, in one pass."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in present(df, columns)])


def source_nulls(df: DataFrame) -> DataFrame:
    """Null counts of the user name and the metrics of an unclean frame."""
    return null_counts(df, [user_column(df), "likes", "num_comments", "comments", "followers"])


def quality_summary(df: DataFrame) -> DataFrame:
    """Total rows and null counts of the cleaned frame, one wide row."""
    return df.agg(
        F.count(F.lit(1)).alias("total_posts"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in present(df, QUALITY_COLUMNS)],
    )


def quality_long(df: DataFrame) -> DataFrame:
    """The quality summary as rows ``(column_name, null_count)``."""
    wide = quality_summary(df)
    nulls = [c for c in wide.columns if c != "total_posts"]
    return wide.unpivot([], nulls, "column_name", "null_count").withColumn(
        "column_name", F.expr("substr(column_name, 6)")
    )


def preview(df: DataFrame, rows: int = 5) -> None:
    """Print the schema and at most ten rows, cells cut at 40 characters."""
    df.printSchema()
    df.limit(min(rows, 10)).show(truncate=40)
