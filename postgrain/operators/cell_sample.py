"""A sample that serves every selection: the k posts with the smallest digests of each cell of the filter cube.

A share of all posts leaves small cells empty; here a cell of k posts or fewer is there with all of them. Each row says how many posts it
stands for, so weighted counts and sums over any selection estimate those of the posts, and the counts of cells are exact. Samples
of parts of the posts merge: the k smallest digests of a union are among those of its parts.

Digests alone are shuffled and ranked; only the rows drawn are fetched, by their digest. Posts are read once and written with their digest to the
shared folder, and so are the digests drawn, at most k of a cell: Spark then knows how few they are and sends them to the posts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postgrain.operators import topk
from postgrain.operators.sampling import COPIES_AT_ONCE, row_text
from postgrain.operators.slices import Selection, select_slice
from postgrain.schema import SLICE_DIMS, present
from postgrain.sources import sinks

CELL_ROWS = 200


def _drawn(keyed: DataFrame, dims: list[str], k: int) -> DataFrame:
    """The copies that have one of the k smallest digests of their cell: dims, ``key``, ``digest``. Equal posts are counted in the map tasks and
    numbered from 0; a copy's digest is that of the post's key and its number."""
    counted = keyed.groupBy(*dims, "key").agg(F.count(F.lit(1)).alias("n"))
    last = F.floor((F.col("n") - 1) / COPIES_AT_ONCE)
    blocks = counted.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    first = F.col("block") * COPIES_AT_ONCE
    numbers = F.sequence(first, F.least(F.col("n"), first + COPIES_AT_ONCE) - 1)
    text = F.lower(F.hex("key"))
    digest = lambda i: F.md5(F.concat_ws("|", text, i.cast("string")))
    # No copy beyond a block's k smallest can be among the cell's. Most posts have one copy, which needs no sorting.
    lowest = F.when(F.col("n") == 1, F.array(digest(F.lit(0)))).otherwise(F.slice(F.array_sort(F.transform(numbers, digest)), 1, k))
    copies = blocks.withColumn("digest", F.explode(lowest))
    order = [F.col("digest"), F.col("key")]
    return topk.top_per_group(copies.select(*dims, "key", "digest"), dims, order, "digest", k).select(*dims, "key", "digest")


def cell_sample(posts: DataFrame, columns: list[str], k: int = CELL_ROWS) -> DataFrame:
    """``columns`` of up to k posts of each cell, with their ``digest`` and ``weight``, the posts of the cell for each post drawn."""
    dims = present(posts, SLICE_DIMS)
    rows = posts.select(*dict.fromkeys([*columns, *dims]))
    path = sinks.shared_folder(posts.sparkSession, "cell-sample")
    keyed = sinks.stored(rows.withColumn("key", F.unhex(F.md5(row_text(rows)))), f"{path}/rows")
    drawn = sinks.stored(_drawn(keyed.select(*dims, "key"), dims, k), f"{path}/drawn")
    # One row per cell; NULL is a value like any other, so cells meet as structs.
    cell = F.to_json(F.struct(*dims), {"ignoreNullFields": "false"}).alias("cell")
    posts_in = keyed.groupBy(*dims).agg(F.count(F.lit(1)).alias("posts")).select(cell, "posts")
    drawn_in = drawn.groupBy(*dims).agg(F.count(F.lit(1)).alias("drawn")).select(cell, "drawn")
    weights = posts_in.join(drawn_in, "cell").select("cell", (F.col("posts") / F.col("drawn")).alias("weight"))
    weighted = drawn.select(cell, "key", "digest").join(weights, "cell")
    wanted = keyed.join(drawn.select("key"), "key", "left_semi").select("*", cell).dropDuplicates(["cell", "key"])
    return wanted.join(weighted, ["cell", "key"]).select(*rows.columns, "digest", "weight")


def merge_samples(parts: DataFrame, k: int = CELL_ROWS) -> DataFrame:
    """One sample from the samples of parts of the posts that have no row in common. Weights are those of the union."""
    dims = present(parts, SLICE_DIMS)
    cell = F.to_json(F.struct(*dims), {"ignoreNullFields": "false"})
    celled = parts.withColumn("cell", cell)
    kept = topk.top_per_group(celled, ["cell"], [F.col("digest")], "digest", k, rank="_rank").drop("_rank")
    posts_in = celled.groupBy("cell").agg(F.sum("weight").alias("posts"))
    drawn_in = kept.groupBy("cell").agg(F.count(F.lit(1)).alias("drawn"))
    weights = posts_in.join(drawn_in, "cell").select("cell", (F.col("posts") / F.col("drawn")).alias("weight"))
    return kept.drop("weight").join(weights, "cell").select(*parts.columns)


def estimated_posts(sample: DataFrame, selection: Selection, condition=None) -> DataFrame:
    """About how many posts of a selection meet a condition: one row. Without a condition that is exact."""
    rows = select_slice(sample, selection)
    rows = rows if condition is None else rows.filter(condition)
    return rows.agg(F.coalesce(F.sum("weight"), F.lit(0.0)).alias("estimated_posts"))
