"""Connected components of links that no machine holds, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postgrain.llm.store import stored


def _stars(links: DataFrame, large: bool) -> DataFrame:
    """Link each node's larger (or else its smaller and own) neighbours to the smallest of all of them."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not large:
        both = both.where(F.col("b") < F.col("a"))
    least = both.groupBy("a").agg(F.min("b").alias("least"))
    least = least.select(F.col("a").alias("centre"), F.least("a", "least").alias("least"))
    seen = both.join(least, both["a"] == least["centre"])
    if large:
        out = seen.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        out = seen.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(
            least.select(F.col("centre").alias("a"), F.col("least").alias("b"))
        )
    return stored(out.where(F.col("a") != F.col("b")).distinct(), "stars")


def _only_stars(links: DataFrame) -> bool:
    """Whether each node is either linked to one smaller node or has only larger ones; the smaller ones then are the roots."""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        links.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    ends = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return ends.where((F.col("up") > 1) | (F.col("up") + F.col("down") > 1)).isEmpty()


def components(links: DataFrame) -> DataFrame:
    """node, root for every node of the links (a, b): root is the smallest node reachable. Self-links do not count."""
    links = links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = stored(links.distinct(), "links")
    while not _only_stars(links):
        links = _stars(_stars(links, large=True), large=False)
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
