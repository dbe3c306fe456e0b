"""Scalar column expressions shared by the cleaners and the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Stripped from both ends of a user name. Spark's plain trim() removes blanks only.
EDGE_WHITESPACE = " \t\r\n"


def normalize_username(user: Column) -> Column:
    """Lower case, outer whitespace removed; the one form used by reports and Bloom filter."""
    return F.lower(F.btrim(user, F.lit(EDGE_WHITESPACE)))


def engagement(likes: Column, comments: Column) -> Column:
    """Likes plus comments, a missing one counting as zero."""
    return F.coalesce(likes, F.lit(0.0)) + F.coalesce(comments, F.lit(0.0))


def per_follower(amount: Column, followers: Column) -> Column:
    """``amount / followers``; NULL when there are no followers."""
    return F.when(followers > 0, amount / followers)


def post_type_label(post_type: Column) -> Column:
    """Neutral display label; anything but 1, NULL included, is the second type."""
    return F.when(post_type == 1, F.lit("Post Type 1")).otherwise(F.lit("Post Type 2"))


def account_label(is_business: Column) -> Column:
    """Display label of the business flag; NULL stays NULL."""
    return F.when(is_business, F.lit("Business")).when(~is_business, F.lit("Non-business"))


def location_or_unknown(location: Column) -> Column:
    """Trimmed location, ``Unknown`` when missing or blank."""
    trimmed = F.trim(location)
    return F.when(trimmed != "", trimmed).otherwise(F.lit("Unknown"))
