"""Every operator as a named query over the test tables.

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame over whole tables. All queries over posts
share one posts table. Doubles are rounded and dates printed, so that results compare by value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postgrain import functions as fx
from postgrain.operators import (
    blocked_bloom, bloom, cell_sample, charts, cleaning, explorer, page_index, profile, rollups, sampling, sketches, slices, topk, userlists,
)
from postgrain.plans import refresh
from postgrain.plans.standin import legacy_raw, posts_raw, table
from postgrain.schema import SAMPLE_OPTIONAL, SAMPLE_REQUIRED, SLICE_DIMS
from postgrain.sources import readers, sinks
from postgrain.streaming import daily

Query = Callable[[SparkSession, str], DataFrame]

# The selections that the slice queries report on.
SELECTION = {
    "post_type_label": "Post Type 1",
    "is_business_account": True,
    "description_category": "STANDARD",
}
ONE_FILTER = {"is_business_account": False}
PAGE, PAGE_SIZE = 1, 100
DEEP_PAGE = 40
SEARCH = {"username": "customer#00000000", "date": "1996"}
EXPLORER_ROWS = 10_000
APPROXIMATE = 10_000
CELL_ROWS = 50
CELL_COLUMNS = ["sid", "date", "username", *SAMPLE_REQUIRED, *SAMPLE_OPTIONAL]


def comparable(df: DataFrame) -> DataFrame:
    """Doubles rounded to six digits, dates as text."""
    out = []
    for f in df.schema.fields:
        col = F.col(f.name)
        if isinstance(f.dataType, T.DoubleType):
            col = F.round(col, 6)
        elif isinstance(f.dataType, T.DateType):
            col = col.cast("string")
        out.append(col.alias(f.name))
    return df.select(*out)


def _posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_posts(posts_raw(spark, sf_dir))


def _over_raw(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: comparable(build(posts_raw(spark, sf_dir)))


def _over_posts(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: comparable(build(_posts(spark, sf_dir)))


def _over_legacy(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: comparable(build(legacy_raw(spark, sf_dir)))


def _over_canonical(build: Callable[[DataFrame], DataFrame]) -> Query:
    """Over cleaned legacy posts under the primary names."""
    return _over_legacy(lambda raw: build(cleaning.to_canonical(cleaning.clean_legacy(raw))))


def _over_cube(build: Callable[[DataFrame], DataFrame]) -> Query:
    return _over_posts(lambda posts: build(slices.filter_cube(posts)))


def _over_sample(build: Callable[[DataFrame], DataFrame]) -> Query:
    return _over_posts(lambda posts: build(sampling.engagement_sample(posts)))


def _csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = legacy_raw(spark, sf_dir)
    path = sinks.shared_folder(spark, "legacy-csv")
    sinks.write_csv(raw, path)
    return readers.read_legacy_csv(spark, path, schema=raw.schema)


def _parquet_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = _posts(spark, sf_dir)
    path = sinks.shared_folder(spark, "posts-by-year")
    sinks.save_clean_posts(clean, path)
    return comparable(readers.read_posts(spark, path).select(*clean.columns))


def _clean_csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = cleaning.clean_legacy(legacy_raw(spark, sf_dir))
    path = sinks.shared_folder(spark, "legacy-clean-csv")
    sinks.write_csv(clean, path)
    return comparable(readers.read_clean_csv(spark, path, clean.schema))


def _result_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = rollups.category_analysis(_posts(spark, sf_dir))
    path = sinks.shared_folder(spark, "results")
    sinks.save_result(result, path, "category_analysis")
    return comparable(readers.read_result(spark, f"{path}/category_analysis", result.schema))


def _bloom_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = sinks.shared_folder(spark, "bloom")
    sinks.save_bloom(_bloom_users(spark, sf_dir), path, bloom.bloom_params, bloom.bloom_words)
    _, params, words = sinks.load_bloom(spark, path, bloom.HASH_VERSION)
    return bloom.bloom_membership(_probes(spark, sf_dir), words, params)


def _approximate_medians(posts: DataFrame) -> DataFrame:
    """How many posts lie below each approximate median and up to it, and whether its rank errs by no more than it may."""
    middle = rollups.medians(posts, accuracy=APPROXIMATE)
    ranks = []
    for c in ("likes", "comments"):
        value = middle.select(f"median_{c}").scalar()
        n, below, upto = F.count(c), F.count_if(F.col(c) < value), F.count_if(F.col(c) <= value)
        slack = n / APPROXIMATE + 1
        ranks += [n.alias(f"n_{c}"), ((below <= n / 2 + slack) & (upto >= n / 2 - slack)).alias(f"{c}_within")]
    return posts.agg(*ranks)


def _doubled_legacy(raw: DataFrame) -> DataFrame:
    """Every post twice; the copy differs and sorts behind the original."""
    return raw.unionByName(raw.withColumn("location", F.lit("Zurich")))


def _username_forms(raw: DataFrame) -> DataFrame:
    forms = raw.groupBy(F.col("username").alias("raw_username")).agg(
        F.count(F.lit(1)).alias("post_count")
    )
    return forms.withColumn("username", fx.normalize_username(F.col("raw_username")))


def _temporal_parts(raw: DataFrame) -> DataFrame:
    dated = raw.select("sid", "date")
    return cleaning.with_date_parts(dated, fx.parse_post_timestamp(F.col("date")))


def _engagement(raw: DataFrame) -> DataFrame:
    metrics = cleaning.with_metric_doubles(
        raw.select("sid", "likes", "comments", "followers"), ["likes", "comments", "followers"]
    )
    return cleaning.with_engagement(metrics)


def _type_labels(raw: DataFrame) -> DataFrame:
    return cleaning.with_post_type_label(raw.select("post_type")).groupBy(
        "post_type", "post_type_label"
    ).agg(F.count(F.lit(1)).alias("post_count"))


def _bloom_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bloom.distinct_users(posts_raw(spark, sf_dir))


def _bloom_tables(
    spark: SparkSession, sf_dir: str, version: str = bloom.HASH_VERSION
) -> tuple[DataFrame, DataFrame, DataFrame]:
    users = _bloom_users(spark, sf_dir)
    params = bloom.bloom_params(users, version=version)
    return users, params, bloom.bloom_words(users, params, version)


def _probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customer names, most of them users, and all supplier names, none of them."""
    customers = table(spark, sf_dir, "customer").select(F.col("c_name").alias("probe"))
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("probe"))
    return bloom.distinct_probes(customers.unionByName(suppliers), "probe")


def _bloom_membership(version: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        _, params, words = _bloom_tables(spark, sf_dir, version)
        return bloom.bloom_membership(_probes(spark, sf_dir), words, params, version)
    return query


def _exact_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bloom.exact_membership(_probes(spark, sf_dir), _bloom_users(spark, sf_dir))


def _bloom_evaluation(version: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        users, params, words = _bloom_tables(spark, sf_dir, version)
        probes = bloom.bloom_probe_set(users)
        return comparable(bloom.bloom_evaluation(params, words, probes, "posts", version))
    return query


def _stored_top_users(selection: slices.Selection) -> Query:
    """From stored lists of totals; the posts are read once, to write these."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = sinks.shared_folder(spark, "user-lists")
        userlists.save_lists(_posts(spark, sf_dir), path)
        return comparable(userlists.top_users(*userlists.load_lists(spark, path), selection))
    return query


def _blocked_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    users = _bloom_users(spark, sf_dir)
    sizes = blocked_bloom.params(users)
    return users, sizes, blocked_bloom.build(users, sizes)


def _blocked_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, sizes, blocks = _blocked_tables(spark, sf_dir)
    return blocked_bloom.membership_verdicts(_probes(spark, sf_dir), blocks, sizes)


def _blocked_evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    users, sizes, blocks = _blocked_tables(spark, sf_dir)
    return comparable(blocked_bloom.evaluation(sizes, blocks, bloom.bloom_probe_set(users), "posts"))


def _reduced_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocked_bloom.membership(_probes(spark, sf_dir), _bloom_users(spark, sf_dir))


def _builders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User names of the customers of one market segment."""
    customers = table(spark, sf_dir, "customer").filter(F.col("c_mktsegment") == "BUILDING")
    return bloom.distinct_users(customers, "c_name")


def _reduced_join(join: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    """Raw posts by, or not by, those users."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        posts = posts_raw(spark, sf_dir).select("sid", "date", fx.normalize_username(F.col("username")).alias("username"))
        return join(posts, _builders(spark, sf_dir))
    return query


def _approximate_unique_users(posts: DataFrame) -> DataFrame:
    """The exact distinct users of every selection, and whether the merged sketches come within five standard errors of them."""
    exact = slices.slice_unique_users(posts)
    keys = [*SLICE_DIMS, *[f"all_{d}" for d in SLICE_DIMS]]
    about = sketches.slice_estimates_cube(sketches.cell_sketches(posts)).select(
        *[F.col(c).alias(f"_{c}") for c in keys], F.col("unique_users").alias("estimate")
    )
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys]
    off = F.abs(F.col("estimate") - F.col("unique_users"))
    within = off <= 5 * sketches.USER_ERROR * F.col("unique_users") + 1
    return exact.join(about, same).select(*keys, "unique_users", within.alias("users_within"))


def _approximate_slice_medians(posts: DataFrame) -> DataFrame:
    """For every selection the values of each measure, and whether the rank of the merged sketches' median errs by no more than it may.

    Posts are counted by cell and value first; only these counts are repeated for the selections that cover a cell.
    """
    keys = [*SLICE_DIMS, *[f"all_{d}" for d in SLICE_DIMS]]
    about = sketches.slice_estimates_cube(sketches.cell_sketches(posts))
    out = None
    for m in sketches.MEASURES:
        middle = about.select(*[F.col(c).alias(f"_{c}") for c in keys], F.col(f"median_{m}").alias("middle"))
        counts = posts.groupBy(*SLICE_DIMS, m).agg(F.count(F.lit(1)).alias("posts"))
        each = counts.select(m, "posts", F.explode(slices.covering_selections(counts)).alias("s")).select(m, "posts", "s.*")
        tied = each.join(middle, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys])
        some = lambda condition: F.coalesce(F.sum(F.when(condition, F.col("posts"))), F.lit(0))
        tally = tied.groupBy(*keys).agg(
            some(F.col(m).isNotNull()).alias("n"), some(F.col(m) < F.col("middle")).alias("below"), some(F.col(m) <= F.col("middle")).alias("upto"),
        )
        slack = 2 * sketches.RANK_ERROR * F.col("n") + 1
        within = (F.col("below") <= F.col("n") / 2 + slack) & (F.col("upto") >= F.col("n") / 2 - slack)
        part = tally.select(*keys, F.lit(m).alias("measure"), "n", within.alias("median_within"))
        out = part if out is None else out.unionByName(part)
    return out


def _cell_sample(posts: DataFrame) -> DataFrame:
    return cell_sample.cell_sample(posts, CELL_COLUMNS, CELL_ROWS)


def _stored_pages(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame, DataFrame]:
    path = sinks.shared_folder(spark, "pages")
    page_index.save_pages(sinks.stored(page_index.page_rows(_posts(spark, sf_dir)), f"{path}/posts"), path)
    return path, *page_index.load_pages(spark, path)


def _seek_page(selection: slices.Selection, page: int) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        _, pages, index = _stored_pages(spark, sf_dir)
        return comparable(page_index.seek_page(pages, index, selection, page, PAGE_SIZE))
    return query


def _indexed_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pages, _ = _stored_pages(spark, sf_dir)
    page_index.save_search(pages, path, list(SEARCH))
    found = page_index.search_pages(pages, page_index.load_search(spark, path), {}, SEARCH, 0, PAGE_SIZE)
    return comparable(found)


def _refreshed(build: Callable[[SparkSession, str], DataFrame]) -> Query:
    """From a store that got the posts in two batches, cut by date; ids recur in both."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        store, raw = sinks.shared_folder(spark, "store"), posts_raw(spark, sf_dir)
        early = F.coalesce(F.col("date") < "1995-01-01", F.lit(False))
        for batch in (raw.filter(early), raw.filter(~early)):
            refresh.apply_batch(spark, store, batch)
        return comparable(build(spark, store))
    return query


def _stream_daily_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as a stream, worked off and stopped."""
    path = sinks.shared_folder(spark, "daily")
    events = daily.read_events(spark, f"{sf_dir}/events.parquet*", table(spark, sf_dir, "events").schema)
    daily.run_available(daily.daily(events, "ts", "event_type", "value"), f"{path}/days", f"{path}/checkpoint")
    return comparable(daily.latest(spark, f"{path}/days"))


def _opened_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw posts opened by source choice and read by SQL."""
    path = sinks.shared_folder(spark, "opened")
    sinks.stored(posts_raw(spark, sf_dir), path)
    source, posts = readers.open_posts(spark, path, f"{path}-none")
    readers.register_views(posts, "opened_posts")
    return spark.sql("SELECT lang, count(*) AS post_count FROM opened_posts GROUP BY lang").withColumn("source", F.lit(source))


def _opened_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = sinks.shared_folder(spark, "opened")
    sinks.write_csv(legacy_raw(spark, sf_dir), path)
    source, posts = readers.open_posts(spark, f"{path}-none", path)
    readers.register_views(posts, "opened_legacy")
    return spark.sql("SELECT content_type, count(*) AS post_count FROM opened_legacy GROUP BY content_type").withColumn("source", F.lit(source))


QUERIES: dict[str, Query] = {
    # Scans
    "posts_scan": _over_raw(lambda raw: raw),
    "legacy_csv_scan": _csv_round_trip,
    # Profiles
    "profile_overview": _over_raw(profile.overview),
    "profile_nulls": _over_raw(profile.source_nulls),
    "quality_summary": _over_posts(profile.quality_summary),
    "clean_stats": _over_raw(cleaning.clean_stats),
    "legacy_profile_overview": _over_legacy(profile.overview),
    "legacy_profile_nulls": _over_legacy(profile.source_nulls),
    "legacy_quality_summary": _over_canonical(profile.quality_summary),
    "legacy_clean_stats": _over_legacy(lambda raw: cleaning.clean_stats(_doubled_legacy(raw))),
    "legacy_top_users": _over_canonical(topk.top_users_by_engagement),
    # Storage round trips
    "posts_stored_by_year": _parquet_round_trip,
    "legacy_clean_csv_stored": _clean_csv_round_trip,
    "result_stored": _result_round_trip,
    # Cleaning
    "normalize_username": _over_raw(_username_forms),
    "temporal_parts": _over_raw(_temporal_parts),
    "engagement": _over_raw(_engagement),
    "post_type_label": _over_raw(_type_labels),
    "dedup_sid": _over_raw(cleaning.dedup_posts),
    "posts_clean": _over_raw(lambda raw: cleaning.clean_posts(raw, dedup=True)),
    "dedup_post_id": _over_legacy(lambda raw: cleaning.keep_first(_doubled_legacy(raw), "post_id")),
    "legacy_clean": _over_legacy(cleaning.clean_legacy),
    # Roll-ups
    "overall_summary": _over_posts(lambda p: rollups.overall_summary(p, exact_medians=True)),
    "approximate_medians": _over_posts(_approximate_medians),
    "overall_medians": _over_posts(lambda p: rollups.medians(p, exact=True)),
    "content_analysis": _over_posts(rollups.content_analysis),
    "category_analysis": _over_posts(rollups.category_analysis),
    "business_analysis": _over_posts(rollups.business_analysis),
    "temporal_year": _over_posts(rollups.temporal_year),
    "temporal_month": _over_posts(rollups.temporal_month),
    "temporal_month_axis": _over_posts(lambda p: rollups.temporal_month(p, fill=True)),
    "temporal_weekday": _over_posts(rollups.temporal_weekday),
    "language_analysis": _over_posts(rollups.language_analysis),
    "legacy_content_analysis": _over_legacy(
        lambda raw: rollups.legacy_content_analysis(cleaning.clean_legacy(raw))
    ),
    "legacy_location_analysis": _over_legacy(
        lambda raw: rollups.legacy_location_analysis(cleaning.clean_legacy(raw))
    ),
    "filter_cube": _over_posts(slices.filter_cube),
    # Top-k
    "top_users_by_posts": _over_posts(topk.top_users_by_posts),
    "top_users_by_followers": _over_posts(topk.top_users_by_followers),
    "top_users_by_likes": _over_posts(topk.top_users_by_likes),
    "top_users_by_engagement": _over_posts(topk.top_users_by_engagement),
    "top_users_cube": _over_posts(topk.top_users_cube),
    # Samples
    "engagement_sample": _over_sample(lambda sample: sample),
    "explorer_sample": _over_posts(lambda p: sampling.explorer_sample(p, EXPLORER_ROWS)),
    # Bloom filter
    "bloom_users": _bloom_users,
    "bloom_params": lambda spark, sf: comparable(bloom.bloom_params(_bloom_users(spark, sf))),
    "bloom_hashes": lambda spark, sf: bloom.hashes(_bloom_users(spark, sf)),
    "bloom_build": lambda spark, sf: _bloom_tables(spark, sf)[2],
    "bloom_membership": _bloom_membership(bloom.HASH_VERSION),
    "bloom_membership_wide": _bloom_membership(bloom.WIDE_HASH_VERSION),
    "exact_membership": _exact_membership,
    "bloom_probe_set": lambda spark, sf: bloom.bloom_probe_set(_bloom_users(spark, sf)),
    "bloom_evaluation": _bloom_evaluation(bloom.HASH_VERSION),
    "bloom_evaluation_wide": _bloom_evaluation(bloom.WIDE_HASH_VERSION),
    "bloom_stored": _bloom_round_trip,
    "bloom_blocked_params": lambda spark, sf: comparable(blocked_bloom.params(_bloom_users(spark, sf))),
    "bloom_blocked_build": lambda spark, sf: _blocked_tables(spark, sf)[2],
    "bloom_blocked_membership": _blocked_membership,
    "bloom_blocked_evaluation": _blocked_evaluation,
    "bloom_reduced_membership": _reduced_membership,
    "bloom_semi_join": _reduced_join(blocked_bloom.semi_join),
    "bloom_anti_join": _reduced_join(blocked_bloom.anti_join),
    # Chart data
    "chart_posts_by_type": _over_posts(
        lambda p: charts.posts_by_type(rollups.content_analysis(p))
    ),
    "chart_top_categories": _over_posts(
        lambda p: topk.top_categories(rollups.category_analysis(p))
    ),
    "chart_category_engagement": _over_posts(
        lambda p: topk.most_engaging_categories(rollups.category_analysis(p))
    ),
    "chart_business_engagement": _over_posts(
        lambda p: charts.business_engagement(rollups.business_analysis(p))
    ),
    "chart_followers_likes": _over_sample(charts.followers_vs_likes),
    "chart_followers_engagement": _over_sample(charts.followers_vs_engagement),
    "chart_image_grade_bins": _over_posts(lambda p: charts.grade_bins(p, "image_grade")),
    "chart_description_grade_bins": _over_posts(
        lambda p: charts.grade_bins(p, "description_grade")
    ),
    # Slices
    "slice_kpis": _over_cube(lambda cube: slices.slice_kpis(cube, SELECTION)),
    "slice_kpis_cube": _over_cube(slices.slice_kpis_cube),
    "slice_unique_users": _over_posts(slices.slice_unique_users),
    "slice_posts_by_type": _over_cube(lambda c: slices.slice_posts_by_type(c, SELECTION)),
    "slice_posts_by_category": _over_cube(lambda c: slices.slice_posts_by_category(c, SELECTION)),
    "slice_engagement_by_category": _over_cube(
        lambda c: slices.slice_engagement_by_category(c, SELECTION)
    ),
    "slice_engagement_by_business": _over_cube(
        lambda c: slices.slice_engagement_by_business(c, SELECTION)
    ),
    "slice_top_users": _over_posts(lambda p: slices.slice_top_users(p, SELECTION)),
    "facet_values": _over_cube(slices.facet_values),
    "slice_kpis_all": _over_cube(lambda cube: slices.slice_kpis(cube, {})),
    "slice_kpis_one_filter": _over_cube(lambda cube: slices.slice_kpis(cube, ONE_FILTER)),
    "slice_posts_by_category_one_filter": _over_cube(
        lambda c: slices.slice_posts_by_category(c, ONE_FILTER)
    ),
    "slice_top_users_all": _over_posts(lambda p: slices.slice_top_users(p, {})),
    "slice_top_users_one_filter": _over_posts(lambda p: slices.slice_top_users(p, ONE_FILTER)),
    "stored_top_users": _stored_top_users(SELECTION),
    "stored_top_users_all": _stored_top_users({}),
    "stored_top_users_one_filter": _stored_top_users(ONE_FILTER),
    "approximate_unique_users": _over_posts(_approximate_unique_users),
    "approximate_slice_medians": _over_posts(_approximate_slice_medians),
    "cell_sample": _over_posts(_cell_sample),
    # Explorer
    "explorer_page": _over_posts(
        lambda p: explorer.explorer_page(p, SELECTION, page=PAGE, size=PAGE_SIZE)
    ),
    "explorer_search": _over_posts(
        lambda p: explorer.explorer_page(p, {}, SEARCH, page=0, size=PAGE_SIZE)
    ),
    "explorer_match_count": _over_posts(lambda p: explorer.explorer_match_count(p, SELECTION)),
    "explorer_by_type": _over_posts(
        lambda p: explorer.explorer_by_type(p, {"is_business_account": True})
    ),
    "seek_page": _seek_page(SELECTION, PAGE),
    "seek_page_deep": _seek_page({}, DEEP_PAGE),
    "indexed_search": _indexed_search,
    # Sources
    "opened_view": _opened_view,
    "opened_fallback": _opened_fallback,
    # Legacy posts through the remaining reports
    "legacy_top_users_by_posts": _over_canonical(topk.top_users_by_posts),
    "legacy_top_users_by_likes": _over_canonical(topk.top_users_by_likes),
    "legacy_temporal_year": _over_canonical(rollups.temporal_year),
    "legacy_temporal_month": _over_canonical(rollups.temporal_month),
    "legacy_temporal_weekday": _over_canonical(rollups.temporal_weekday),
    # Refresh and stream
    "refreshed_posts": _refreshed(refresh.clean_posts),
    "refreshed_cube": _refreshed(refresh.filter_cube),
    "refreshed_top_users": _refreshed(lambda spark, store: refresh.top_users(spark, store, ONE_FILTER)),
    "stream_daily_events": _stream_daily_events,
}
