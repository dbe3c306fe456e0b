"""Timestamp parsing that yields NULL on bad input, also under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The date patterns of the two layouts.
POST_PATTERN = "yyyy-MM-dd HH:mm:ss"
LEGACY_ISO_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"  # the Z is literal: session time zone
LEGACY_ZONED_PATTERN = "yyyy-MM-dd HH:mm:ss z"


def parse_post_timestamp(text: Column) -> Column:
    return F.try_to_timestamp(text, F.lit(POST_PATTERN))


def parse_legacy_timestamp(text: Column) -> Column:
    """First of: ISO with literal Z, date-time with zone, Spark's default forms."""
    return F.coalesce(
        F.try_to_timestamp(text, F.lit(LEGACY_ISO_PATTERN)),
        F.try_to_timestamp(text, F.lit(LEGACY_ZONED_PATTERN)),
        F.try_to_timestamp(text),
    )


def date_parts(ts: Column) -> dict[str, Column]:
    """Calendar columns of a timestamp. ``day_of_week`` runs from 1 (Sunday) to 7."""
    day = F.to_date(ts)
    return {
        "post_date": day,
        "post_year": F.year(day),
        "post_month": F.month(day),
        "post_day": F.dayofmonth(day),
        "day_of_week": F.dayofweek(day),
        "post_hour": F.hour(ts),
    }
