"""Small hand-made post tables."""

from __future__ import annotations

POST_SCHEMA = (
    "sid long, profile_id long, shortcode string, date string, post_type int, likes long, "
    "comments long, username string, followers long, is_business_account boolean, lang string, "
    "description_category string, description_grade double, image_grade double, "
    "description string, bio string"
)


def post(sid, user="ann", **given):
    row = {
        "sid": sid, "profile_id": 1, "shortcode": f"s{sid}", "date": "2019-03-04 05:06:07",
        "post_type": 1, "likes": 10, "comments": 2, "username": user, "followers": 100,
        "is_business_account": False, "lang": "en", "description_category": "food",
        "description_grade": 0.5, "image_grade": 0.5, "description": "d", "bio": "b",
    }
    return tuple((row | given).values())


def posts(spark, rows):
    return spark.createDataFrame(rows, POST_SCHEMA)


def bag(df):
    """Rows as a sorted list, NULLs first."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is not None, str(v)) for v in r])
