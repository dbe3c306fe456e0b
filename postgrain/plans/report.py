"""The whole report: clean once, store, then every result table from the stored posts.

    python -m postgrain.plans.report POSTS.parquet LEGACY.csv OUT_DIR

Cleaned posts are written as Parquet and read back, so no result repeats the cleaning and
a lost executor costs at most the current result. The posts, the
user names and the Bloom filter stay distributed throughout.
"""

from __future__ import annotations

import logging
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from postgrain.operators import bloom, charts, cleaning, profile, rollups, sampling, slices, topk
from postgrain.schema import SLICE_DIMS, user_column
from postgrain.sources import readers, sinks

log = logging.getLogger(__name__)

Build = Callable[[DataFrame], DataFrame]

# Result table -> (columns it needs, how to build it). A table whose columns are missing is
# skipped; columns beyond the needed ones are used where present.
RESULTS: dict[str, tuple[list[str], Build]] = {
    "overall_summary": (["likes", "comments", "engagement"], rollups.overall_summary),
    "content_analysis": (["post_type", "engagement"], rollups.content_analysis),
    "category_analysis": (["description_category", "engagement"], rollups.category_analysis),
    "business_analysis": (["is_business_account", "engagement"], rollups.business_analysis),
    "top_users_by_posts": ([], topk.top_users_by_posts),
    "top_users_by_followers": (["followers"], topk.top_users_by_followers),
    "top_users_by_likes": (["likes"], topk.top_users_by_likes),
    "top_users_by_engagement": (["engagement"], topk.top_users_by_engagement),
    "filter_cube": (["post_type", *SLICE_DIMS, "engagement"], slices.filter_cube),
    "top_users_cube": ([*SLICE_DIMS, "engagement"], topk.top_users_cube),
    "unique_users_cube": (SLICE_DIMS, slices.slice_unique_users),
    "temporal_year": (["post_year", "engagement"], rollups.temporal_year),
    "temporal_month": (["post_month", "engagement"], rollups.temporal_month),
    "temporal_weekday": (["day_of_week", "engagement"], rollups.temporal_weekday),
    "language_analysis": (["lang"], rollups.language_analysis),
    "quality_summary": ([], profile.quality_summary),
    "legacy_content_analysis": (
        ["content_type", "engagement"], rollups.legacy_content_analysis
    ),
    "location_analysis": (["location", "engagement"], rollups.legacy_location_analysis),
    "engagement_sample": (
        ["followers", "likes", "comments", "engagement"], sampling.engagement_sample
    ),
    "facet_values": (
        ["post_type", *SLICE_DIMS, "engagement"],
        lambda posts: slices.facet_values(slices.filter_cube(posts)),
    ),
    "chart_image_grade_bins": (
        ["image_grade", "likes"], lambda posts: charts.grade_bins(posts, "image_grade")
    ),
    "chart_description_grade_bins": (
        ["description_grade", "likes"], lambda posts: charts.grade_bins(posts, "description_grade")
    ),
}

# Chart table -> (stored result it is drawn from, how to build it).
CHARTS: dict[str, tuple[str, Build]] = {
    "top_users": ("top_users_by_engagement", lambda users: users),
    "chart_posts_by_type": ("content_analysis", charts.posts_by_type),
    "chart_top_categories": ("category_analysis", topk.top_categories),
    "chart_category_engagement": ("category_analysis", topk.most_engaging_categories),
    "chart_business_engagement": ("business_analysis", charts.business_engagement),
    "chart_followers_likes": ("engagement_sample", charts.followers_vs_likes),
    "chart_followers_engagement": ("engagement_sample", charts.followers_vs_engagement),
}


def store_clean(kind: str, raw: DataFrame, out_dir: str) -> DataFrame:
    """Clean, store and re-open the posts under their primary column names."""
    spark, path = raw.sparkSession, f"{out_dir}/posts_clean"
    if kind == "primary":
        clean = cleaning.clean_posts(raw, dedup=True)
    else:
        clean = cleaning.to_canonical(cleaning.clean_legacy(raw))
    sinks.save_clean_posts(clean, path)
    return readers.read_posts(spark, path)


def store_results(posts: DataFrame, out_dir: str) -> dict[str, int]:
    """Write every result table the posts have the columns for; row counts by name."""
    rows = {}
    schemas = {}
    for name, (needs, build) in RESULTS.items():
        if set(needs) <= set(posts.columns):
            table = build(posts)
            schemas[name] = table.schema
            rows[name] = sinks.save_result(table, out_dir, name)
    for name, (source, build) in CHARTS.items():
        if source in schemas:
            stored = readers.read_result(
                posts.sparkSession, f"{out_dir}/{source}", schemas[source]
            )
            rows[name] = sinks.save_result(build(stored), out_dir, name)
    return rows


def store_bloom(
    posts: DataFrame, out_dir: str, kind: str, version: str = bloom.HASH_VERSION
) -> dict[str, int]:
    """Build and store the Bloom tables, then evaluate the stored filter."""
    spark, path = posts.sparkSession, f"{out_dir}/bloom"
    sinks.save_bloom(
        bloom.distinct_users(posts, user_column(posts)), path,
        lambda users: bloom.bloom_params(users, version=version),
        lambda users, params: bloom.bloom_words(users, params, version),
    )
    users, params, words = sinks.load_bloom(spark, path, version)
    outcome = bloom.bloom_evaluation(params, words, bloom.bloom_probe_set(users), kind, version)
    name = "bloom_filter_results"
    rows = {name: sinks.save_result(outcome, out_dir, name)}
    result = readers.read_result(spark, f"{out_dir}/{name}", outcome.schema)
    if result.filter("positive_false_negatives > 0").count():
        raise RuntimeError("the Bloom filter misses names that were inserted")
    return rows


def run_report(kind: str, raw: DataFrame, out_dir: str) -> dict[str, int]:
    """Clean, store, report. ``kind`` is "primary" or "fallback", as from ``open_posts``."""
    rows = {"clean_stats": sinks.save_result(
        cleaning.clean_stats(raw), f"{out_dir}/results", "clean_stats"
    )}
    posts = store_clean(kind, raw, out_dir)
    readers.register_views(posts, "posts")
    return rows | store_results(posts, f"{out_dir}/results") | store_bloom(
        posts, f"{out_dir}/results", kind
    )


def main(primary: str, fallback: str, out_dir: str) -> None:
    logging.basicConfig(level=logging.INFO)
    spark = SparkSession.builder.appName("postgrain-report").getOrCreate()
    kind, raw = readers.open_posts(spark, primary, fallback)
    for name, n in run_report(kind, raw, out_dir).items():
        log.info("%s: %d rows", name, n)


if __name__ == "__main__":
    main(*sys.argv[1:])
