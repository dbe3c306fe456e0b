"""The same queries as SQL over the test tables, to check results in a second engine."""

from __future__ import annotations

POSTS_RAW = r"""
posts_raw AS (
  SELECT
    l_orderkey * 10 + l_linenumber AS sid,
    c_custkey AS sid_profile,
    c_custkey AS profile_id,
    substr(md5(CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)), 1, 11) AS shortcode,
    CASE WHEN l_suppkey % 40 = 0 THEN 'not-a-date'
         ELSE strftime(l_shipdate + to_seconds(l_partkey * 97 % 86400), '%Y-%m-%d %H:%M:%S') END AS date,
    CASE WHEN l_quantity = 50 THEN NULL WHEN l_linestatus = 'O' THEN 1 ELSE 2 END AS post_type,
    CASE WHEN l_discount <> 0.1::DOUBLE THEN CAST(floor(l_extendedprice) AS BIGINT) END AS likes,
    CASE WHEN l_discount <> 0.0::DOUBLE THEN CAST(floor(l_quantity) AS BIGINT) END AS comments,
    CASE WHEN c_custkey % 50 = 0 THEN NULL
         WHEN c_custkey % 50 = 1 THEN '   '
         WHEN c_custkey % 3 = 0 THEN '  ' || upper(c_name) || ' '
         ELSE c_name END AS username,
    CAST(floor(c_acctbal) AS BIGINT) AS followers,
    c_mktsegment IN ('AUTOMOBILE', 'MACHINERY') AS is_business_account,
    CASE c_nationkey % 4 WHEN 0 THEN 'en' WHEN 1 THEN 'de' WHEN 2 THEN 'es' WHEN 3 THEN 'fr' END AS lang,
    l_discount AS description_grade,
    CASE WHEN l_tax <> 0.08::DOUBLE THEN l_tax END AS image_grade,
    CAST(p_size AS BIGINT) AS following,
    CAST(p_size AS BIGINT) * 3 AS num_posts,
    p_type AS description_category,
    CASE WHEN p_size % 7 <> 0 THEN p_name END AS description
  FROM lineitem
  LEFT JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN part ON l_partkey = p_partkey
)"""

NORMALIZED = r"lower(trim(username, ' ' || chr(9) || chr(13) || chr(10)))"
TIMESTAMP = "try_strptime(date, '%Y-%m-%d %H:%M:%S')"

# Source columns in order, without the key, for the total order of de-duplication.
_REST = [
    "sid_profile", "profile_id", "shortcode", "date", "post_type", "likes", "comments",
    "username", "followers", "is_business_account", "lang", "description_grade", "image_grade",
    "following", "num_posts", "description_category", "description",
]


def _ascending(names: list[str]) -> str:
    return ", ".join(f"{n} NULLS FIRST" for n in names)


SURVIVOR = f"""row_number() OVER (PARTITION BY sid
  ORDER BY {TIMESTAMP} ASC NULLS LAST, {_ascending(_REST)})"""

USABLE = f"""
usable AS (
  SELECT * REPLACE (
    {NORMALIZED} AS username,
    CAST(likes AS DOUBLE) AS likes, CAST(comments AS DOUBLE) AS comments,
    CAST(followers AS DOUBLE) AS followers, CAST(following AS DOUBLE) AS following,
    CAST(num_posts AS DOUBLE) AS num_posts)
  FROM posts_raw WHERE {NORMALIZED} <> ''
)"""


def _derived(name: str, source: str) -> str:
    return f"""
{name} AS (
  SELECT * REPLACE (coalesce(description, '') AS description),
    engagement / CASE WHEN followers > 0 THEN followers END AS engagement_rate,
    likes / CASE WHEN followers > 0 THEN followers END AS likes_per_follower,
    comments / CASE WHEN followers > 0 THEN followers END AS comments_per_follower,
    CAST(ts AS DATE) AS post_date, year(ts) AS post_year, month(ts) AS post_month,
    day(ts) AS post_day, dayofweek(ts) + 1 AS day_of_week, hour(ts) AS post_hour,
    CASE WHEN post_type = 1 THEN 'Post Type 1' ELSE 'Post Type 2' END AS post_type_label
  FROM (SELECT *, coalesce(likes, 0) + coalesce(comments, 0) AS engagement, {TIMESTAMP} AS ts
        FROM {source})
)"""


POSTS = f"{POSTS_RAW},{USABLE},{_derived('posts', 'usable')}"

_DOUBLES = {
    "likes", "comments", "followers", "following", "num_posts", "engagement", "engagement_rate",
    "likes_per_follower", "comments_per_follower", "description_grade", "image_grade",
}


def _shown(names: list[str]) -> str:
    """A select list in which doubles are rounded and dates printed."""
    out = []
    for n in names:
        if n in _DOUBLES:
            out.append(f"round({n}, 6) AS {n}")
        elif n == "post_date":
            out.append("CAST(post_date AS VARCHAR) AS post_date")
        else:
            out.append(n)
    return ", ".join(out)


CLEAN_COLUMNS = [
    "sid", *_REST, "engagement", "engagement_rate", "likes_per_follower",
    "comments_per_follower", "post_date", "post_year", "post_month", "post_day", "day_of_week",
    "post_hour", "post_type_label",
]

LEGACY_RAW = r"""
legacy_raw AS (
  SELECT
    CAST(event_id AS VARCHAR) AS post_id,
    CAST(user_id AS VARCHAR) AS user_posted,
    event_type AS content_type,
    CASE WHEN event_id % 11 = 0 THEN 'n/a' ELSE CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) END AS likes,
    json_extract_string(props, '$.k') AS num_comments,
    CASE WHEN event_id % 17 = 0 THEN 'bad'
         WHEN event_id % 3 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z'
         WHEN event_id % 3 = 1 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') || ' UTC'
         ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS date_posted,
    CASE user_id % 4 WHEN 1 THEN '  ' WHEN 2 THEN ' Paris ' WHEN 3 THEN 'Rome' END AS location
  FROM events
)"""

LEGACY = LEGACY_RAW + """,
legacy AS (
  SELECT post_id, lower(trim(user_posted)) AS user_posted, content_type,
    TRY_CAST(likes AS DOUBLE) AS likes, TRY_CAST(num_comments AS DOUBLE) AS num_comments,
    date_posted,
    CASE WHEN trim(location) <> '' THEN trim(location) ELSE 'Unknown' END AS location,
    coalesce(TRY_CAST(likes AS DOUBLE), 0) + coalesce(TRY_CAST(num_comments AS DOUBLE), 0) AS engagement,
    CAST(coalesce(try_strptime(date_posted, '%Y-%m-%dT%H:%M:%S.%gZ'),
                  try_strptime(date_posted, '%Y-%m-%d %H:%M:%S UTC'),
                  try_strptime(date_posted, '%Y-%m-%d %H:%M:%S')) AS DATE) AS post_date
  FROM legacy_raw WHERE trim(user_posted) <> ''
)"""


def _avg(*names: str) -> str:
    return ", ".join(f"round(avg({n}), 6) AS avg_{n}" for n in names)


CONTENT = _avg("likes", "comments", "engagement", "followers", "image_grade", "description_grade")
ACCOUNT = _avg("likes", "comments", "engagement", "followers", "engagement_rate")
MEDIANS = "quantile_disc(likes, 0.5) AS median_likes, quantile_disc(comments, 0.5) AS median_comments"

_SUMMED = {
    "likes": "likes", "comments": "comments", "engagement": "engagement",
    "followers": "followers", "rate": "engagement_rate",
}
CUBE_SUMS = ", ".join(
    f"round(sum({c}), 6) AS sum_{n}, count({c}) AS cnt_{n}" for n, c in _SUMMED.items()
)
KPIS = ", ".join(f"round(avg({c}), 6) AS avg_{n}" for n, c in _SUMMED.items())
DIMS = "post_type_label, is_business_account, description_category"
ALL_FLAGS = ", ".join(f"grouping({d}) = 1 AS all_{d}" for d in DIMS.split(", "))

TYPE_1 = "post_type_label = 'Post Type 1'"
BUSINESS = "is_business_account"
STANDARD = "description_category = 'STANDARD'"

# ---------------------------------------------------------------- samples
SAMPLE_COLUMNS = [
    "followers", "likes", "comments", "engagement", "image_grade", "description_grade",
    "post_type_label", "post_type", "is_business_account", "description_category", "post_year",
]
_FRACTIONS = _DOUBLES - {"post_year"}


def _each_copy(columns: list[str]) -> str:
    """A frame with the digest of each row and its number among equal rows."""
    text = ", ".join(
        f"CAST(CAST({c} AS DECIMAL(38,6)) AS VARCHAR)" if c in _FRACTIONS else f"CAST({c} AS VARCHAR)"
        for c in columns
    )
    names = ", ".join(columns)
    return f"""(SELECT *, md5(concat_ws('|', {text}, CAST(copy - 1 AS VARCHAR))) AS digest
    FROM (SELECT {names}, row_number() OVER (PARTITION BY {names}) AS copy FROM posts))"""


SAMPLE = POSTS + f""",
sample AS (SELECT {", ".join(SAMPLE_COLUMNS)}
  FROM {_each_copy(["sid", "date", "username", *SAMPLE_COLUMNS])} WHERE digest < '028f5c28')"""
EXPLORER = POSTS + f""",
sample AS (SELECT {", ".join(CLEAN_COLUMNS)} FROM {_each_copy(CLEAN_COLUMNS)}
  ORDER BY digest, {_ascending(CLEAN_COLUMNS)} LIMIT 10000)"""
PAGE_COLUMNS = [
    "username", "shortcode", "post_type_label", "likes", "comments", "followers", "num_posts",
    "is_business_account", "description_category", "description_grade", "image_grade",
    "post_date", "date",
]


def _grade_bins(grade: str) -> str:
    edges = " + ".join(
        f"CAST(g > lo + {i}.0::DOUBLE * ((hi - lo) / 10) AS INT)" for i in range(1, 10)
    )
    return f"""WITH {POSTS},
graded AS (SELECT {grade} AS g, likes FROM posts WHERE {grade} IS NOT NULL AND likes >= 0),
span AS (SELECT min(g) AS lo, max(g) AS hi FROM graded),
placed AS (SELECT CASE WHEN hi > lo THEN 1 + {edges} ELSE 5 END AS bin, lo, hi, likes
           FROM graded, span)
SELECT CAST(bin AS INT) AS bin,
  round(CASE WHEN bin = 10 THEN hi ELSE lo + bin * ((hi - lo) / 10) END, 6) AS upper_edge,
  count(*) AS post_count, round(avg(likes), 6) AS mean_likes
FROM placed GROUP BY bin, lo, hi"""


# ---------------------------------------------------------------- Bloom filter
USERS = POSTS_RAW + f""",
users AS (SELECT DISTINCT {NORMALIZED} AS username FROM posts_raw WHERE {NORMALIZED} <> '')"""
PARAMS = """
sized AS (SELECT count(*) AS n,
  greatest(128, CAST(ceil(-(count(*) * ln(0.01::DOUBLE)) / (ln(2.0::DOUBLE) * ln(2.0::DOUBLE))) AS BIGINT)) AS m
  FROM users),
params AS (SELECT n, m,
  CAST(least(20, greatest(2, round_even(m::DOUBLE / n * ln(2.0::DOUBLE), 0))) AS INT) AS k FROM sized)"""


def _hashes(name: str, source: str) -> str:
    points = "list_transform(string_split(username, ''), lambda c: CAST(unicode(c) AS BIGINT))"
    return f"""
{name} AS (SELECT username,
  list_reduce(list_prepend(5381::BIGINT, {points}), lambda h, v: (h * 33 + v) % 2147483647) AS h1,
  greatest(1, list_reduce(list_prepend(0::BIGINT, {points}),
    lambda h, v: (h * 65599 + v) % 2147483647)) AS h2
  FROM {source})"""


def _positions(name: str, source: str) -> str:
    return f"""
{name} AS (SELECT username, (h1 % m + i * (h2 % m)) % m AS pos
  FROM (SELECT username, h1, h2, m, unnest(range(0, k)) AS i FROM {source}, params))"""


BITS = """
bits AS (SELECT DISTINCT pos FROM user_positions)"""


def _wide_hashes(name: str, source: str) -> str:
    return f"""
{name} AS (SELECT username, CAST('0x' || substr(md5(username), 1, 15) AS BIGINT) AS h1,
  greatest(1, CAST('0x' || substr(md5(username), 16, 15) AS BIGINT)) AS h2 FROM {source})"""


def _bloom(hashes=_hashes) -> str:
    return (
        f"{USERS},{PARAMS},{hashes('user_hashes', 'users')},"
        f"{_positions('user_positions', 'user_hashes')},{BITS}"
    )


BLOOM = _bloom()
MUTATED = """
  substr(username, 1, CAST('0x' || substr(md5(username), 1, 4) AS INT) % length(username))
  || substr('abcdefghijklmnopqrstuvwxyz0123456789',
            CAST('0x' || substr(md5(username), 5, 4) AS INT) % 36 + 1, 1)
  || substr(username, CAST('0x' || substr(md5(username), 1, 4) AS INT) % length(username) + 2)"""
PROBE_SET = f"""
positive AS (SELECT username FROM users),
far AS (SELECT 'not_a_real_user_' || CAST(i AS VARCHAR) AS username FROM range(1, 501) t(i)),
near AS (SELECT DISTINCT {MUTATED} AS username
  FROM (SELECT username FROM users ORDER BY md5('near' || username), username LIMIT 300)),
probe_set AS (
  SELECT username, 'positive' AS probe_group FROM positive
  UNION ALL SELECT username, 'far_negative' FROM far WHERE username NOT IN (SELECT username FROM users)
  UNION ALL SELECT username, 'near_miss' FROM near WHERE username NOT IN (SELECT username FROM users)
)"""
PROBES = f"""
probes AS (SELECT DISTINCT {NORMALIZED} AS username
  FROM (SELECT c_name AS username FROM customer UNION ALL SELECT s_name FROM supplier)
  WHERE {NORMALIZED} <> '')"""


def _looked_up(probes: str, hashes=_hashes) -> str:
    return f"""{hashes('probe_hashes', f"(SELECT DISTINCT username FROM {probes})")},
{_positions('probe_positions', 'probe_hashes')},
looked_up AS (SELECT username, bool_and(pos IN (SELECT pos FROM bits)) AS bloom_hit
  FROM probe_positions GROUP BY username)"""


def _membership(hashes=_hashes) -> str:
    return f"""WITH {_bloom(hashes)},{PROBES},{_looked_up('probes', hashes)}
SELECT username, CASE WHEN bloom_hit THEN 'POSSIBLY PRESENT' ELSE 'DEFINITELY ABSENT' END
  AS bloom_verdict FROM looked_up"""


def _evaluation(version: str, hashes=_hashes) -> str:
    return f"""WITH {_bloom(hashes)},{PROBE_SET},{_looked_up('probe_set', hashes)},
tally AS (SELECT
  count(*) FILTER (probe_group = 'positive') AS positive_queries,
  count(*) FILTER (probe_group = 'positive' AND NOT bloom_hit) AS positive_false_negatives,
  count(*) FILTER (probe_group = 'far_negative') AS negative_queries,
  count(*) FILTER (probe_group = 'far_negative' AND bloom_hit) AS false_positives,
  count(*) FILTER (probe_group = 'near_miss') AS near_queries,
  count(*) FILTER (probe_group = 'near_miss' AND bloom_hit) AS near_false_positives
  FROM probe_set JOIN looked_up USING (username))
SELECT 'posts' AS data_source, n AS inserted_users, m AS bit_array_size, k AS hash_functions,
  '{version}' AS hash_version, 0.01::DOUBLE AS false_positive_target,
  round(pow(1 - exp(-k * n::DOUBLE / m), k), 6) AS theoretical_fpr, tally.*,
  round(false_positives / negative_queries, 6) AS false_positive_rate,
  round(near_false_positives / near_queries, 6) AS near_false_positive_rate
FROM tally, params"""


# Names per block at the target rate; a block has 8 words of 64 bits.
BLOCKED = f"""{USERS},
sized AS (SELECT count(*) AS n, greatest(1, CAST(ceil(count(*) / 50.69654412154757::DOUBLE) AS BIGINT)) AS blocks FROM users),
params AS (SELECT n, blocks, blocks * 512 AS m, 8 AS k FROM sized),{_wide_hashes('user_hashes', 'users')},
user_bits AS (SELECT DISTINCT h1 % blocks AS block, lane, (h2 >> (6 * lane)) & 63 AS place
  FROM user_hashes, params, range(0, 8) t(lane))"""
BLOCKED_RATE = """(SELECT round(sum(exp(j * ln(n::DOUBLE / blocks) - n::DOUBLE / blocks - lgamma(j + 1))
  * pow(1 - pow(63.0::DOUBLE / 64, j), 8)), 6) FROM range(1, 400) t(j))"""
BLOCKED_LOOKUP = """
looked_up AS (SELECT username, bool_and(b.place IS NOT NULL) AS bloom_hit
  FROM (SELECT username, h1 % blocks AS block, lane, (h2 >> (6 * lane)) & 63 AS place
        FROM probe_hashes, params, range(0, 8) t(lane)) p LEFT JOIN user_bits b USING (block, lane, place) GROUP BY username)"""
BUILDERS = f"(SELECT {NORMALIZED} FROM (SELECT c_name AS username FROM customer WHERE c_mktsegment = 'BUILDING'))"


def _blocked_words() -> str:
    words = ", ".join(
        f"""coalesce(bit_or(CASE WHEN lane = {i} THEN CASE WHEN place = 63 THEN (-9223372036854775808)::BIGINT
  ELSE 1::BIGINT << CAST(place AS INT) END END), 0) AS w{i}""" for i in range(8)
    )
    return f"WITH {BLOCKED} SELECT block, {words} FROM user_bits GROUP BY block"


def _blocked_evaluation() -> str:
    plain = _evaluation("blocked-1")
    tally = plain[plain.index("tally AS"):plain.index("SELECT 'posts'")]
    rates = plain[plain.index("round(false_positives"):plain.index("FROM tally")]
    return f"""WITH {BLOCKED},{PROBE_SET},{_wide_hashes('probe_hashes', '(SELECT DISTINCT username FROM probe_set)')},{BLOCKED_LOOKUP},
{tally}SELECT 'posts' AS data_source, n AS inserted_users, m AS bit_array_size, k AS hash_functions, 'blocked-1' AS hash_version,
  0.01::DOUBLE AS false_positive_target, {BLOCKED_RATE} AS theoretical_fpr, tally.*, {rates} FROM tally, params"""


def _cell_sample() -> str:
    columns = ["sid", "date", "username", *SAMPLE_COLUMNS]
    text = ", ".join(
        f"CAST(CAST({c} AS DECIMAL(38,6)) AS VARCHAR)" if c in _FRACTIONS else f"CAST({c} AS VARCHAR)" for c in columns
    )
    names = ", ".join(columns)
    return f"""WITH {POSTS},
numbered AS (SELECT *, md5(concat_ws('|', md5(concat_ws('|', {text})), CAST(copy - 1 AS VARCHAR))) AS digest
  FROM (SELECT {names}, row_number() OVER (PARTITION BY {names}) AS copy FROM posts)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY {DIMS} ORDER BY digest) AS place, count(*) OVER (PARTITION BY {DIMS}) AS posts FROM numbered)
SELECT {_shown(columns)}, digest, round(posts / least(posts, 50), 6) AS weight FROM ranked WHERE place <= 50"""


def _top(measures: str, by: str) -> str:
    return f"""WITH {POSTS}
SELECT username, {measures}, count(*) AS post_count FROM posts GROUP BY username
ORDER BY {by} DESC NULLS LAST, username LIMIT 15"""


def _slice_top_users(where: str) -> str:
    return f"""WITH {POSTS}
SELECT username, sum(engagement) AS total_engagement, round(avg(engagement), 6) AS avg_engagement,
  count(*) AS post_count FROM posts WHERE {where}
GROUP BY username ORDER BY sum(engagement) DESC, username LIMIT 15"""


def _legacy_by(key: str) -> str:
    return f"""WITH {LEGACY}
SELECT {key}, count(engagement) AS posts_count, round(avg(engagement), 6) AS average_engagement,
  round(sum(engagement), 6) AS total_engagement FROM legacy GROUP BY {key}"""


def _calendar(part: str, name: str, *metrics: str) -> str:
    return f"""WITH {POSTS}
SELECT {part} AS {name}, count(*) AS post_count, {_avg(*metrics)} FROM posts GROUP BY {part}"""


def _legacy_calendar(part: str, name: str, *metrics: str) -> str:
    return f"""WITH {LEGACY}
SELECT {part} AS {name}, count(*) AS post_count, {_avg(*metrics)} FROM legacy GROUP BY 1"""


def _legacy_top(measure: str, by: str) -> str:
    return f"""WITH {LEGACY}
SELECT user_posted AS username, {measure}count(*) AS post_count FROM legacy GROUP BY user_posted
ORDER BY {by} DESC NULLS LAST, user_posted LIMIT 15"""


ORACLE_SQL: dict[str, str] = {
    "posts_scan": f"WITH {POSTS_RAW} SELECT * FROM posts_raw",
    "legacy_csv_scan": f"WITH {LEGACY_RAW} SELECT * FROM legacy_raw",
    "profile_overview": f"""WITH {POSTS_RAW}
SELECT count(*) AS row_count, 18 AS column_count,
  (SELECT count(*) FROM (SELECT DISTINCT username FROM posts_raw)) AS distinct_usernames FROM posts_raw""",
    "profile_nulls": f"""WITH {POSTS_RAW}
SELECT count(*) - count(username) AS null_username, count(*) - count(likes) AS null_likes,
  count(*) - count(comments) AS null_comments, count(*) - count(followers) AS null_followers
FROM posts_raw""",
    "quality_summary": f"""WITH {POSTS}
SELECT count(*) AS total_posts, count(*) - count(username) AS null_username,
  count(*) - count(likes) AS null_likes, count(*) - count(comments) AS null_comments,
  count(*) - count(followers) AS null_followers, count(*) - count(post_date) AS null_post_date
FROM posts""",
    "clean_stats": f"""WITH {POSTS_RAW},{USABLE},
survivors AS (SELECT sid, {TIMESTAMP} AS ts FROM usable QUALIFY {SURVIVOR} = 1)
SELECT (SELECT count(*) FROM posts_raw) AS rows_before,
  (SELECT count(*) FROM posts_raw) - (SELECT count(*) FROM usable) AS unusable_users_removed,
  (SELECT count(*) FROM usable) - count(*) AS duplicate_sids_removed,
  count(*) AS rows_after, count(DISTINCT sid) AS distinct_sids, 0 AS rows_without_id,
  count(*) - count(ts) AS null_dates, 29 AS column_count
FROM survivors""",
    "legacy_profile_overview": f"""WITH {LEGACY_RAW}
SELECT count(*) AS row_count, 7 AS column_count,
  (SELECT count(*) FROM (SELECT DISTINCT user_posted FROM legacy_raw)) AS distinct_usernames FROM legacy_raw""",
    "legacy_profile_nulls": f"""WITH {LEGACY_RAW}
SELECT count(*) - count(user_posted) AS null_user_posted, count(*) - count(likes) AS null_likes,
  count(*) - count(num_comments) AS null_num_comments FROM legacy_raw""",
    "legacy_quality_summary": f"""WITH {LEGACY}
SELECT count(*) AS total_posts, count(*) - count(user_posted) AS null_username,
  count(*) - count(likes) AS null_likes, count(*) - count(num_comments) AS null_comments,
  count(*) - count(post_date) AS null_post_date FROM legacy""",
    "legacy_clean_stats": f"""WITH {LEGACY}
SELECT (SELECT 2 * count(*) FROM legacy_raw) AS rows_before,
  (SELECT 2 * count(*) FROM legacy_raw) - 2 * count(*) AS unusable_users_removed,
  count(*) AS duplicate_sids_removed, count(*) AS rows_after, count(DISTINCT post_id) AS distinct_sids,
  0 AS rows_without_id, count(*) - count(post_date) AS null_dates, 13 AS column_count FROM legacy""",
    "legacy_top_users": f"""WITH {LEGACY}
SELECT user_posted AS username, round(sum(engagement), 6) AS total_engagement,
  round(avg(engagement), 6) AS avg_engagement, count(*) AS post_count FROM legacy
GROUP BY user_posted ORDER BY sum(engagement) DESC NULLS LAST, user_posted LIMIT 15""",
    "posts_stored_by_year": f"WITH {POSTS} SELECT {_shown(CLEAN_COLUMNS)} FROM posts",
    "normalize_username": f"""WITH {POSTS_RAW}
SELECT username AS raw_username, count(*) AS post_count, {NORMALIZED} AS username
FROM posts_raw GROUP BY posts_raw.username""",
    "temporal_parts": f"""WITH {POSTS_RAW}
SELECT sid, date, CAST(CAST(ts AS DATE) AS VARCHAR) AS post_date, year(ts) AS post_year,
  month(ts) AS post_month, day(ts) AS post_day, dayofweek(ts) + 1 AS day_of_week,
  hour(ts) AS post_hour
FROM (SELECT sid, date, {TIMESTAMP} AS ts FROM posts_raw)""",
    "engagement": f"""WITH {POSTS_RAW}
SELECT sid, CAST(likes AS DOUBLE) AS likes, CAST(comments AS DOUBLE) AS comments,
  CAST(followers AS DOUBLE) AS followers,
  CAST(coalesce(likes, 0) + coalesce(comments, 0) AS DOUBLE) AS engagement,
  CASE WHEN followers > 0 THEN round((coalesce(likes, 0) + coalesce(comments, 0)) / followers, 6) END AS engagement_rate,
  CASE WHEN followers > 0 THEN round(likes / followers, 6) END AS likes_per_follower,
  CASE WHEN followers > 0 THEN round(comments / followers, 6) END AS comments_per_follower
FROM posts_raw""",
    "post_type_label": f"""WITH {POSTS_RAW}
SELECT post_type, CASE WHEN post_type = 1 THEN 'Post Type 1' ELSE 'Post Type 2' END AS post_type_label,
  count(*) AS post_count FROM posts_raw GROUP BY 1, 2""",
    "dedup_sid": f"WITH {POSTS_RAW} SELECT * FROM posts_raw QUALIFY {SURVIVOR} = 1",
    "posts_clean": f"""WITH {POSTS_RAW},{USABLE},
survivors AS (SELECT * FROM usable QUALIFY {SURVIVOR} = 1),{_derived('posts', 'survivors')}
SELECT {_shown(CLEAN_COLUMNS)} FROM posts""",
    "dedup_post_id": f"WITH {LEGACY_RAW} SELECT * FROM legacy_raw",
    "legacy_clean": f"""WITH {LEGACY}
SELECT *  REPLACE (CAST(post_date AS VARCHAR) AS post_date), engagement AS engagement_total,
  year(post_date) AS post_year, month(post_date) AS post_month,
  dayofweek(post_date) + 1 AS day_of_week FROM legacy""",
    "legacy_clean_csv_stored": f"""WITH {LEGACY}
SELECT *  REPLACE (CAST(post_date AS VARCHAR) AS post_date), engagement AS engagement_total,
  year(post_date) AS post_year, month(post_date) AS post_month,
  dayofweek(post_date) + 1 AS day_of_week FROM legacy""",
    "result_stored": f"""WITH {POSTS}
SELECT description_category, count(*) AS post_count, {CONTENT}
FROM posts GROUP BY description_category""",
    "approximate_medians": f"""WITH {POSTS}
SELECT count(likes) AS n_likes, true AS likes_within, count(comments) AS n_comments,
  true AS comments_within FROM posts""",
    "overall_summary": f"""WITH {POSTS}
SELECT count(*) AS total_posts, count(DISTINCT username) AS unique_users, {ACCOUNT},
  count(*) FILTER (is_business_account) AS business_post_count,
  count(*) FILTER (NOT is_business_account) AS non_business_post_count, {MEDIANS} FROM posts""",
    "overall_medians": f"WITH {POSTS} SELECT {MEDIANS} FROM posts",
    "content_analysis": f"""WITH {POSTS}
SELECT post_type, post_type_label, count(*) AS post_count, {CONTENT}
FROM posts GROUP BY post_type, post_type_label""",
    "category_analysis": f"""WITH {POSTS}
SELECT description_category, count(*) AS post_count, {CONTENT}
FROM posts GROUP BY description_category""",
    "business_analysis": f"""WITH {POSTS}
SELECT is_business_account, count(*) AS post_count, {ACCOUNT}
FROM posts GROUP BY is_business_account""",
    "temporal_year": _calendar("post_year", "year", "engagement", "likes"),
    "temporal_month": _calendar("post_month", "month", "engagement"),
    "temporal_month_axis": f"""WITH {POSTS}
SELECT CAST(m AS INT) AS month, count(sid) AS post_count, {_avg("engagement")}
FROM range(1, 13) t(m) LEFT JOIN posts ON post_month = m GROUP BY m""",
    "temporal_weekday": _calendar("day_of_week", "weekday", "engagement"),
    "language_analysis": f"WITH {POSTS} SELECT lang, count(*) AS post_count FROM posts GROUP BY lang",
    "legacy_content_analysis": _legacy_by("content_type"),
    "legacy_location_analysis": _legacy_by("location"),
    "filter_cube": f"""WITH {POSTS}
SELECT post_type, {DIMS}, count(*) AS post_count, {CUBE_SUMS}
FROM posts GROUP BY post_type, {DIMS}""",
    "top_users_by_posts": f"""WITH {POSTS}
SELECT username, count(*) AS post_count FROM posts GROUP BY username
ORDER BY post_count DESC, username LIMIT 15""",
    "top_users_by_followers": _top("max(followers) AS max_followers", "max_followers"),
    "top_users_by_likes": _top("round(sum(likes), 6) AS total_likes", "total_likes"),
    "top_users_by_engagement": _top(
        "round(sum(engagement), 6) AS total_engagement, round(avg(engagement), 6) AS avg_engagement",
        "total_engagement",
    ),
    "top_users_cube": f"""WITH {POSTS}
SELECT {DIMS}, username, sum(engagement) AS total_engagement, count(*) AS post_count,
  row_number() OVER (PARTITION BY {DIMS} ORDER BY sum(engagement) DESC, username) AS rn
FROM posts GROUP BY {DIMS}, username QUALIFY rn <= 15""",
    "engagement_sample": f"WITH {SAMPLE} SELECT {_shown(SAMPLE_COLUMNS)} FROM sample",
    "explorer_sample": f"WITH {EXPLORER} SELECT {_shown(CLEAN_COLUMNS)} FROM sample",
    "bloom_users": f"WITH {USERS} SELECT username FROM users",
    "bloom_params": f"""WITH {USERS},{PARAMS}
SELECT n, m, k, 0.01::DOUBLE AS false_positive_target,
  round(pow(1 - exp(-k * n::DOUBLE / m), k), 6) AS theoretical_fpr,
  'doublehash-1' AS hash_version FROM params""",
    "bloom_hashes": f"""WITH {USERS},{_hashes('user_hashes', 'users')}
SELECT username, h1, h2 FROM user_hashes""",
    "bloom_build": f"""WITH {BLOOM}
SELECT pos // 64 AS word, bit_or(CASE WHEN pos % 64 = 63 THEN (-9223372036854775808)::BIGINT
  ELSE 1::BIGINT << CAST(pos % 64 AS INT) END) AS bits FROM bits GROUP BY 1""",
    "bloom_membership": _membership(),
    "bloom_membership_wide": _membership(_wide_hashes),
    "bloom_stored": _membership(),
    "exact_membership": f"""WITH {USERS},{PROBES}
SELECT username, CASE WHEN username IN (SELECT username FROM users) THEN 'PRESENT' ELSE 'ABSENT' END
  AS exact_verdict FROM probes""",
    "bloom_probe_set": f"WITH {USERS},{PROBE_SET} SELECT username, probe_group FROM probe_set",
    "bloom_evaluation": _evaluation("doublehash-1"),
    "bloom_evaluation_wide": _evaluation("doublehash-2", _wide_hashes),
    "chart_posts_by_type": f"""WITH {POSTS}
SELECT post_type_label, count(*) AS post_count FROM posts GROUP BY post_type_label""",
    "chart_top_categories": f"""WITH {POSTS}
SELECT description_category, count(*) AS post_count FROM posts GROUP BY description_category
ORDER BY post_count DESC, description_category LIMIT 15""",
    "chart_category_engagement": f"""WITH {POSTS}
SELECT description_category, round(avg(engagement), 6) AS avg_engagement
FROM posts GROUP BY description_category
ORDER BY avg(engagement) DESC NULLS LAST, description_category LIMIT 12""",
    "chart_business_engagement": f"""WITH {POSTS}
SELECT CASE WHEN is_business_account THEN 'Business' WHEN NOT is_business_account THEN 'Non-business' END
  AS account, round(avg(engagement), 6) AS avg_engagement FROM posts GROUP BY is_business_account""",
    "chart_followers_likes": f"""WITH {SAMPLE}
SELECT followers, likes, round(log10(followers), 6) AS log_followers,
  round(log10(likes + 1), 6) AS log_likes FROM sample WHERE followers > 0 AND likes >= 0""",
    "chart_followers_engagement": f"""WITH {SAMPLE}
SELECT followers, engagement, round(log10(followers), 6) AS log_followers,
  round(log10(engagement + 1), 6) AS log_engagement FROM sample WHERE followers > 0""",
    "chart_image_grade_bins": _grade_bins("image_grade"),
    "chart_description_grade_bins": _grade_bins("description_grade"),
    "slice_kpis": f"""WITH {POSTS}
SELECT count(*) AS post_count, {KPIS} FROM posts WHERE {TYPE_1} AND {BUSINESS} AND {STANDARD}""",
    "slice_kpis_cube": f"""WITH {POSTS}
SELECT {DIMS}, {ALL_FLAGS}, count(*) AS post_count, {KPIS} FROM posts GROUP BY CUBE ({DIMS})""",
    "slice_unique_users": f"""WITH {POSTS}
SELECT {DIMS}, {ALL_FLAGS}, count(DISTINCT username) AS unique_users
FROM posts GROUP BY CUBE ({DIMS})""",
    "slice_posts_by_type": f"""WITH {POSTS}
SELECT post_type_label, count(*) AS post_count FROM posts WHERE {BUSINESS} AND {STANDARD}
GROUP BY post_type_label""",
    "slice_posts_by_category": f"""WITH {POSTS}
SELECT description_category, count(*) AS post_count FROM posts
WHERE {TYPE_1} AND {BUSINESS} AND description_category IS NOT NULL GROUP BY description_category
ORDER BY post_count DESC, description_category LIMIT 15""",
    "slice_engagement_by_category": f"""WITH {POSTS}
SELECT description_category, round(avg(engagement), 6) AS avg_engagement FROM posts
WHERE {TYPE_1} AND {BUSINESS} AND description_category IS NOT NULL GROUP BY description_category
ORDER BY avg(engagement) DESC, description_category LIMIT 12""",
    "slice_engagement_by_business": f"""WITH {POSTS}
SELECT CASE WHEN is_business_account THEN 'Business' ELSE 'Non-business' END AS account,
  round(avg(engagement), 6) AS avg_engagement FROM posts
WHERE {TYPE_1} AND {STANDARD} AND is_business_account IS NOT NULL GROUP BY is_business_account""",
    "slice_top_users": f"""WITH {POSTS}
SELECT username, sum(engagement) AS total_engagement, round(avg(engagement), 6) AS avg_engagement,
  count(*) AS post_count FROM posts WHERE {TYPE_1} AND {BUSINESS} AND {STANDARD}
GROUP BY username ORDER BY sum(engagement) DESC, username LIMIT 15""",
    "facet_values": f"""WITH {POSTS}
SELECT DISTINCT 'post_type_label' AS facet, post_type_label AS choice FROM posts
UNION ALL SELECT DISTINCT 'description_category', description_category FROM posts
WHERE description_category IS NOT NULL""",
    "slice_kpis_all": f"WITH {POSTS} SELECT count(*) AS post_count, {KPIS} FROM posts",
    "slice_kpis_one_filter": f"""WITH {POSTS}
SELECT count(*) AS post_count, {KPIS} FROM posts WHERE NOT {BUSINESS}""",
    "slice_posts_by_category_one_filter": f"""WITH {POSTS}
SELECT description_category, count(*) AS post_count FROM posts
WHERE NOT {BUSINESS} AND description_category IS NOT NULL GROUP BY description_category
ORDER BY post_count DESC, description_category LIMIT 15""",
    "slice_top_users_all": _slice_top_users("true"),
    "slice_top_users_one_filter": _slice_top_users(f"NOT {BUSINESS}"),
    "explorer_page": f"""WITH {POSTS}
SELECT {_shown(PAGE_COLUMNS)} FROM (SELECT * FROM posts WHERE {TYPE_1} AND {BUSINESS} AND {STANDARD}
  ORDER BY sid, {_ascending(PAGE_COLUMNS)} LIMIT 100 OFFSET 100)""",
    "explorer_search": f"""WITH {POSTS}
SELECT {_shown(PAGE_COLUMNS)} FROM (SELECT * FROM posts
  WHERE contains(username, 'customer#00000000') AND contains(date, '1996')
  ORDER BY sid, {_ascending(PAGE_COLUMNS)} LIMIT 100)""",
    "explorer_match_count": f"""WITH {POSTS}
SELECT count(*) FILTER ({TYPE_1} AND {BUSINESS} AND {STANDARD}) AS matching_rows,
  count(*) AS all_rows FROM posts""",
    "explorer_by_type": f"""WITH {POSTS}
SELECT post_type_label, count(*) AS posts FROM posts WHERE {BUSINESS} GROUP BY post_type_label""",
    "bloom_blocked_params": f"""WITH {BLOCKED}
SELECT n, blocks, m, k, 0.01::DOUBLE AS false_positive_target, {BLOCKED_RATE} AS theoretical_fpr, 'blocked-1' AS hash_version FROM params""",
    "bloom_blocked_build": _blocked_words(),
    "bloom_blocked_membership": f"""WITH {BLOCKED},{PROBES},{_wide_hashes('probe_hashes', 'probes')},{BLOCKED_LOOKUP}
SELECT username, CASE WHEN bloom_hit THEN 'POSSIBLY PRESENT' ELSE 'DEFINITELY ABSENT' END AS bloom_verdict FROM looked_up""",
    "bloom_blocked_evaluation": _blocked_evaluation(),
    "bloom_semi_join": f"""WITH {POSTS_RAW}
SELECT sid, date, {NORMALIZED} AS username FROM posts_raw WHERE {NORMALIZED} IN {BUILDERS}""",
    "bloom_anti_join": f"""WITH {POSTS_RAW}
SELECT sid, date, {NORMALIZED} AS username FROM posts_raw WHERE NOT coalesce({NORMALIZED} IN {BUILDERS}, false)""",
    "stored_top_users_all": _slice_top_users("true"),
    "stored_top_users_one_filter": _slice_top_users(f"NOT {BUSINESS}"),
    "stored_top_users": _slice_top_users(f"{TYPE_1} AND {BUSINESS} AND {STANDARD}"),
    "approximate_unique_users": f"""WITH {POSTS}
SELECT {DIMS}, {ALL_FLAGS}, count(DISTINCT username) AS unique_users, true AS users_within
FROM posts GROUP BY CUBE ({DIMS})""",
    "approximate_slice_medians": f"""WITH {POSTS}
SELECT {DIMS}, {ALL_FLAGS}, 'likes' AS measure, count(likes) AS n, true AS median_within FROM posts GROUP BY CUBE ({DIMS})
UNION ALL SELECT {DIMS}, {ALL_FLAGS}, 'comments', count(comments), true FROM posts GROUP BY CUBE ({DIMS})""",
    "cell_sample": _cell_sample(),
}
ORACLE_SQL |= {
    "seek_page": ORACLE_SQL["explorer_page"],
    "seek_page_deep": f"""WITH {POSTS}
SELECT {_shown(PAGE_COLUMNS)} FROM (SELECT * FROM posts ORDER BY sid, {_ascending(PAGE_COLUMNS)} LIMIT 100 OFFSET 4000)""",
    "indexed_search": ORACLE_SQL["explorer_search"],
    "opened_view": f"WITH {POSTS_RAW} SELECT lang, count(*) AS post_count, 'primary' AS source FROM posts_raw GROUP BY lang",
    "opened_fallback": f"WITH {LEGACY_RAW} SELECT content_type, count(*) AS post_count, 'fallback' AS source FROM legacy_raw GROUP BY content_type",
    "legacy_top_users_by_posts": _legacy_top("", "post_count"),
    "legacy_top_users_by_likes": _legacy_top("round(sum(likes), 6) AS total_likes, ", "total_likes"),
    "legacy_temporal_year": _legacy_calendar("year(post_date)", "year", "likes", "engagement"),
    "legacy_temporal_month": _legacy_calendar("month(post_date)", "month", "engagement"),
    "legacy_temporal_weekday": _legacy_calendar("dayofweek(post_date) + 1", "weekday", "engagement"),
    "refreshed_posts": ORACLE_SQL["posts_clean"],
    "refreshed_cube": f"""WITH {POSTS_RAW},{USABLE},
survivors AS (SELECT * FROM usable QUALIFY {SURVIVOR} = 1),{_derived('posts', 'survivors')}
SELECT post_type, {DIMS}, count(*) AS post_count, {CUBE_SUMS} FROM posts GROUP BY post_type, {DIMS}""",
    "refreshed_top_users": f"""WITH {POSTS_RAW},{USABLE},
survivors AS (SELECT * FROM usable QUALIFY {SURVIVOR} = 1),{_derived('posts', 'survivors')}
SELECT username, sum(engagement) AS total_engagement, round(avg(engagement), 6) AS avg_engagement, count(*) AS post_count
FROM posts WHERE NOT {BUSINESS} GROUP BY username ORDER BY sum(engagement) DESC, username LIMIT 15""",
    "stream_daily_events": """SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_type AS kind, count(*) AS posts,
  round(sum(value), 6) AS total, count(value) AS values FROM events GROUP BY 1, 2""",
}
ORACLE_SQL["bloom_reduced_membership"] = ORACLE_SQL["exact_membership"]
