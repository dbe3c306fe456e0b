"""Post tables derived from the star-schema test tables, for tests and benchmarks.

``posts_raw`` has the primary layout and ``legacy_raw`` the legacy one, with the faults
the cleaners must handle: missing and padded user names, dates and numbers that do not
parse, missing metrics, repeated ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _second(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss``, whatever the session time zone."""
    return F.substring(ts.cast("string"), 1, 19)


def _whole(amount: Column) -> Column:
    return F.floor(amount).cast("bigint")


def _item_columns() -> dict[str, Column]:
    seconds = F.make_dt_interval(secs=(F.col("l_partkey") * 97 % 86400).cast("decimal(18,6)"))
    quantity, discount, tax = F.col("l_quantity"), F.col("l_discount"), F.col("l_tax")
    order, line = F.col("l_orderkey"), F.col("l_linenumber")
    return {
        "sid": order * 10 + line,
        "shortcode": F.substring(F.md5(
            F.concat(order.cast("string"), F.lit("-"), line.cast("string"))
        ), 1, 11),
        "date": F.when(F.col("l_suppkey") % 40 == 0, F.lit("not-a-date"))
        .otherwise(_second(F.col("l_shipdate") + seconds)),
        "post_type": F.when(quantity == 50, F.lit(None))
        .when(F.col("l_linestatus") == "O", F.lit(1)).otherwise(F.lit(2)),
        "likes": F.when(discount != 0.10, _whole(F.col("l_extendedprice"))),
        "comments": F.when(discount != 0.0, _whole(quantity)),
        "description_grade": discount,
        "image_grade": F.when(tax != 0.08, tax),
    }


def _account_columns() -> dict[str, Column]:
    key, name = F.col("c_custkey"), F.col("c_name")
    languages = F.array(*[F.lit(x) for x in ("en", "de", "es", "fr")])
    return {
        "sid_profile": key,
        "profile_id": key,
        "username": F.when(key % 50 == 1, F.lit("   "))
        .when((key % 50 != 0) & (key % 3 == 0), F.concat(F.lit("  "), F.upper(name), F.lit(" ")))
        .when(key % 50 != 0, name),
        "followers": _whole(F.col("c_acctbal")),
        "is_business_account": F.col("c_mktsegment").isin("AUTOMOBILE", "MACHINERY"),
        "lang": F.element_at(languages, (F.col("c_nationkey") % 4 + 1).cast("int")),
    }


def _part_columns() -> dict[str, Column]:
    size = F.col("p_size").cast("bigint")
    return {
        "following": size,
        "num_posts": size * 3,
        "description_category": F.col("p_type"),
        "description": F.when(F.col("p_size") % 7 != 0, F.col("p_name")),
    }


# The primary layout, in column order.
POST_COLUMNS = [
    "sid", "sid_profile", "profile_id", "shortcode", "date", "post_type", "likes", "comments",
    "username", "followers", "is_business_account", "lang", "description_grade", "image_grade",
    "following", "num_posts", "description_category", "description",
]


def posts_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One post per line item, with its order's customer as author.

    The dimension tables hold each key once, so the left joins neither add nor drop rows. Orders and
    customers are joined first, while there are only orders. Line items and orders grow together, so the
    hint has Spark shuffle both by order instead of broadcasting either.
    """
    by_order = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left"
    )
    posts = table(spark, sf_dir, "lineitem").hint("merge").join(
        by_order, F.col("l_orderkey") == F.col("o_orderkey"), "left"
    ).join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"), "left")
    columns = _item_columns() | _account_columns() | _part_columns()
    return posts.select(*[columns[c].alias(c) for c in POST_COLUMNS])


def legacy_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One legacy post per event, every column a string."""
    event, user = F.col("event_id"), F.col("user_id")
    second = _second(F.col("ts"))
    millis = F.rpad(F.substring(F.col("ts").cast("string"), 21, 3), 3, "0")
    iso = F.concat(F.replace(second, F.lit(" "), F.lit("T")), F.lit("."), millis, F.lit("Z"))
    return table(spark, sf_dir, "events").select(
        event.cast("string").alias("post_id"),
        user.cast("string").alias("user_posted"),
        F.col("event_type").alias("content_type"),
        F.when(event % 11 == 0, F.lit("n/a"))
        .otherwise(_whole(F.col("value")).cast("string")).alias("likes"),
        F.get_json_object("props", "$.k").alias("num_comments"),
        F.when(event % 17 == 0, F.lit("bad"))
        .when(event % 3 == 0, iso)
        .when(event % 3 == 1, F.concat(second, F.lit(" UTC")))
        .otherwise(second).alias("date_posted"),
        F.when(user % 4 == 1, F.lit("  "))
        .when(user % 4 == 2, F.lit(" Paris "))
        .when(user % 4 == 3, F.lit("Rome")).alias("location"),
    )
