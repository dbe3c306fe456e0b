"""Small documents with the odd cases that every operator must take."""

from __future__ import annotations

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows, extra=""):
    """rows: (doc_id, text, lang, source)"""
    full = [(*r, len(r[1]) if r[1] is not None else None) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def odd_rows(text="the quick brown fox jumps over the lazy dog"):
    return [
        (1, text, "en", "a"), (2, text, "en", "a"), (2, text, "en", "a"), (3, None, "en", "b"), (4, "", None, None),
        (5, " \n\t", "de", "b"), (None, text + " again", "en", None), (7, "x", "fr", "é"), (8, "12 34 !!", "en", "a"),
        (9, (text + " ") * 3000, "en", "c"), (10, "naïve café — ‘quoted’ 日本 \u3000 <|endoftext|> \x00 tab\tend  ", "fr", "c"),
    ]


def with_clashes(df, *names):
    """The frame with further columns of names that operators use themselves."""
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit("clash").alias(n) for n in names if n not in df.columns])
