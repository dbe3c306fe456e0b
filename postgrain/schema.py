"""Column names and result-table names of the two post layouts.

The lists below are fixed values of the data model: they name the columns that
the cleaners, the samples and the explorer look for. A column that a frame does
not have is skipped, so the same operators serve both layouts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

# Primary (Parquet) layout.
POST_METRICS = ["likes", "comments", "followers", "following", "num_posts"]
POST_TEXT = ["description", "bio"]

# Legacy (CSV) layout.
LEGACY_IDS = ["post_id", "pk", "user_posted_id", "content_id", "shortcode"]
LEGACY_METRICS = [
    "likes", "num_comments", "followers", "posts_count", "video_view_count", "video_play_count",
]

# Row-sample and explorer projections.
SAMPLE_REQUIRED = ["followers", "likes", "comments", "engagement"]
SAMPLE_OPTIONAL = [
    "image_grade", "description_grade", "post_type_label", "post_type",
    "is_business_account", "description_category", "post_year",
]
EXPLORER_COLUMNS = [
    "username", "shortcode", "post_type_label", "likes", "comments", "followers", "num_posts",
    "is_business_account", "description_category", "description_grade", "image_grade",
    "post_date", "date",
]

# Columns whose nulls the quality report counts.
QUALITY_COLUMNS = [
    "username", "user_posted", "likes", "comments", "num_comments", "followers",
    "post_date", "date_posted",
]

# The three dimensions a selection can filter on.
SLICE_DIMS = ["post_type_label", "is_business_account", "description_category"]


def present(df: DataFrame, names: list[str]) -> list[str]:
    """The given names that ``df`` has, in the given order."""
    have = set(df.columns)
    return [n for n in names if n in have]


def user_column(df: DataFrame) -> str:
    """``username`` in the primary layout, ``user_posted`` in the legacy one."""
    for name in ("username", "user_posted"):
        if name in df.columns:
            return name
    raise ValueError("no user column: expected 'username' or 'user_posted'")
