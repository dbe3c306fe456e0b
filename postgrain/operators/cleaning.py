"""Cleaners of the two layouts, each a chain of ``DataFrame.transform`` steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from postgrain import functions as fx
from postgrain.schema import (
    LEGACY_IDS, LEGACY_METRICS, POST_METRICS, POST_TEXT, present, user_column,
)


def with_normalized_user(df: DataFrame, user: str = "username") -> DataFrame:
    return df.withColumn(user, fx.normalize_username(F.col(user)))


def drop_unusable_users(df: DataFrame, user: str = "username") -> DataFrame:
    """Rows whose normalised user name is neither NULL nor empty."""
    return df.filter(F.col(user).isNotNull() & (F.col(user) != ""))


def with_metric_doubles(df: DataFrame, metrics: list[str]) -> DataFrame:
    """Metrics as doubles. Text that is no number, NaN and infinities become NULL."""
    finite = {c: F.col(c).try_cast("double") for c in present(df, metrics)}
    return df.withColumns({
        c: F.when(F.abs(v) < float("inf"), v) for c, v in finite.items()
    })


def with_ids_as_text(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in present(df, LEGACY_IDS)})


def with_engagement(
    df: DataFrame, likes: str = "likes", comments: str = "comments"
) -> DataFrame:
    """Engagement, and per-follower rates where the frame has followers."""
    df = df.withColumn("engagement", fx.engagement(F.col(likes), F.col(comments)))
    if "followers" not in df.columns:
        return df
    followers = F.col("followers")
    return df.withColumns({
        "engagement_rate": fx.per_follower(F.col("engagement"), followers),
        "likes_per_follower": fx.per_follower(F.col(likes), followers),
        "comments_per_follower": fx.per_follower(F.col(comments), followers),
    })


def with_date_parts(df: DataFrame, ts: Column, keep_hour_and_day: bool = True) -> DataFrame:
    parts = fx.date_parts(ts)
    if not keep_hour_and_day:
        parts = {k: v for k, v in parts.items() if k not in ("post_day", "post_hour")}
    return df.withColumns(parts)


def with_post_type_label(df: DataFrame) -> DataFrame:
    if "post_type" not in df.columns:
        return df
    return df.withColumn("post_type_label", fx.post_type_label(F.col("post_type")))


def with_empty_text(df: DataFrame) -> DataFrame:
    """Missing descriptions and bios as empty strings."""
    cols = present(df, POST_TEXT)
    return df.fillna("", cols) if cols else df


def keep_first(df: DataFrame, key: str, first: list[Column] | None = None) -> DataFrame:
    """One row per ``key``: the first by ``first``, then by all other columns. Rows without key all stay.

    Ordering by every column makes the survivor independent of partitioning. Spark
    cuts each map task down to one row per key before the shuffle (WindowGroupLimit),
    so a key that holds much of the data does not gather in one task.
    """
    rest = [F.col(f.name) for f in df.schema.fields if f.name != key]
    order = Window.partitionBy(key, "_alone").orderBy(*(first or []), *rest)
    # Each row without key is a group of its own, so they neither vanish nor gather in one task.
    alone = F.when(F.col(key).isNull(), F.monotonically_increasing_id())
    ranked = df.withColumn("_alone", alone).withColumn("_rank", F.row_number().over(order))
    return ranked.filter("_rank = 1").drop("_rank", "_alone")


def dedup_posts(df: DataFrame) -> DataFrame:
    """One row per ``sid``: the earliest readable date wins."""
    if "sid" not in df.columns:
        return df
    earliest = fx.parse_post_timestamp(F.col("date")).asc_nulls_last()
    return keep_first(df, "sid", [earliest])


def usable_posts(raw: DataFrame) -> DataFrame:
    """Posts with a user name, names and metrics in order; source columns alone."""
    return (
        raw.transform(with_normalized_user)
        .transform(drop_unusable_users)
        .transform(with_metric_doubles, POST_METRICS)
    )


def with_derived_columns(usable: DataFrame) -> DataFrame:
    """What the primary cleaner adds to usable posts."""
    return (
        usable.transform(with_engagement)
        .transform(with_date_parts, fx.parse_post_timestamp(F.col("date")))
        .transform(with_post_type_label)
        .transform(with_empty_text)
    )


def clean_posts(raw: DataFrame, dedup: bool = False) -> DataFrame:
    """The whole primary cleaner.

    De-duplication runs on the source columns, before the derived ones are added, so
    that the shuffle carries only what was read.
    """
    df = usable_posts(raw)
    return with_derived_columns(dedup_posts(df) if dedup else df)


def clean_legacy(raw: DataFrame, dedup: bool = True) -> DataFrame:
    """The whole legacy cleaner. Each step applies where its columns exist."""
    df = raw.transform(with_ids_as_text)
    if "user_posted" in df.columns:
        df = df.transform(with_normalized_user, "user_posted").transform(
            drop_unusable_users, "user_posted"
        )
    if dedup and "post_id" in df.columns:
        dated = "date_posted" in df.columns
        earliest = [fx.parse_legacy_timestamp(F.col("date_posted")).asc_nulls_last()] if dated else None
        df = keep_first(df, "post_id", earliest)
    df = with_metric_doubles(df, LEGACY_METRICS)
    if {"likes", "num_comments"} <= set(df.columns):
        total = fx.engagement(F.col("likes"), F.col("num_comments"))
        df = df.withColumns({"engagement": total, "engagement_total": total})
    if "date_posted" in df.columns:
        parsed = fx.parse_legacy_timestamp(F.col("date_posted"))
        df = with_date_parts(df, parsed, keep_hour_and_day=False)
    if "location" in df.columns:
        df = df.withColumn("location", fx.location_or_unknown(F.col("location")))
    return df


# Legacy names and the primary names they correspond to.
CANONICAL_NAMES = {
    "post_id": "sid",
    "user_posted": "username",
    "num_comments": "comments",
    "posts_count": "num_posts",
    "date_posted": "date",
}


def to_canonical(legacy: DataFrame) -> DataFrame:
    """A cleaned legacy frame under the primary names, so that every report accepts it."""
    have = set(legacy.columns)
    names = {old: new for old, new in CANONICAL_NAMES.items() if old in have and new not in have}
    df = legacy.withColumnsRenamed(names)
    if "followers" in df.columns and {"likes", "comments"} <= set(df.columns):
        df = with_engagement(df)
    return df


def clean_stats(raw: DataFrame) -> DataFrame:
    """Row counts before and after cleaning with de-duplication, as one row, for either layout.

    One scan and one shuffle of (id, three counts, earliest date): since the earliest
    readable date survives de-duplication, its minimum per id says whether the
    survivor has a date, and no whole row needs to be compared. Rows without id all stay: they are
    counted apart and are no distinct id.
    """
    primary = "sid" in raw.columns
    key, date = ("sid", "date") if primary else ("post_id", "date_posted")
    parse = fx.parse_post_timestamp if primary else fx.parse_legacy_timestamp
    cleaned = clean_posts(raw) if primary else clean_legacy(raw)
    user = fx.normalize_username(F.col(user_column(raw)))
    usable = F.coalesce(user != "", F.lit(False))
    parsed = parse(F.col(date))
    per_id = raw.groupBy(F.col(key).alias("id")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(usable).alias("kept"),
        F.count_if(usable & parsed.isNull()).alias("dateless"),
        F.min(F.when(usable, parsed)).alias("first_ts"),
    )
    named = F.col("id").isNotNull()
    survives = named & (F.col("kept") > 0)
    without = F.coalesce(F.sum(F.when(~named, F.col("kept"))), F.lit(0))
    return per_id.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_before"),
        F.coalesce(F.sum(F.col("n") - F.col("kept")), F.lit(0)).alias("unusable_users_removed"),
        F.coalesce(F.sum(F.when(survives, F.col("kept") - 1)), F.lit(0)).alias(
            "duplicate_sids_removed"
        ),
        (F.count_if(survives) + without).alias("rows_after"),
        F.count_if(survives).alias("distinct_sids"),
        without.alias("rows_without_id"),
        (
            F.count_if(survives & F.col("first_ts").isNull())
            + F.coalesce(F.sum(F.when(~named, F.col("dateless"))), F.lit(0))
        ).alias("null_dates"),
        F.lit(len(cleaned.columns)).alias("column_count"),
    )
