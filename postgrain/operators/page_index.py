"""Deep pages and column search over many posts, from posts stored in explorer order.

The posts are dealt over ranges of that order, one partition folder each, and counted by range and cell of the filter cube. The counts say in which
range a page of any selection begins, so a page reads that range alone, whether it is the first or the millionth.

For searches the distinct values of each column are kept, sorted and cut into blocks, with the ranges that they occur in, and, by column, postings of the blocks
that hold a trigram: values of one block share most trigrams, so there are far fewer postings than trigrams of values. A term's trigrams are intersected to the blocks that
can hold it; `contains` has the last word, on the values of these blocks, which name the ranges to read, and on the posts of these ranges. Terms of fewer than
three characters scan the values.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from postgrain.operators.slices import Selection, select_slice
from postgrain.schema import EXPLORER_COLUMNS, SLICE_DIMS, present

RANGE_ROWS = 100_000
# Folders of a table, so also the numbers that the list of a search's ranges may hold.
MOST_RANGES = 100_000
GRAM = 3
# Values of a block, at least; more where there would be more blocks than MOST_RANGES.
BLOCK_VALUES = 1_000
VALUES = "value string, range int, block bigint, column string"
POSTINGS = "gram string, block bigint, column string"


def _shown(df: DataFrame) -> list[str]:
    return present(df, EXPLORER_COLUMNS) or [c for c in df.columns if c not in ("range", "row")]


def _order(df: DataFrame) -> list[str]:
    return list(dict.fromkeys([*present(df, ["sid", "post_id"]), *_shown(df)]))


def page_rows(posts: DataFrame) -> DataFrame:
    """The columns that pages are ordered, shown and selected by."""
    return posts.select(*dict.fromkeys([*_order(posts), *present(posts, SLICE_DIMS)]))


def save_pages(posts: DataFrame, path: str, range_rows: int = RANGE_ROWS) -> None:
    """Posts by range, and the number of posts per range and cell.

    Equal posts are spread over ranges by their number in the input, which should be stored files so that a task run again numbers them alike.
    """
    spark = posts.sparkSession
    rows = page_rows(posts)
    ranges = min(MOST_RANGES, max(1, math.ceil(rows.count() / range_rows)))
    order = _order(rows)
    dealt = rows.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(ranges, *order, "row")
    dealt.withColumn("range", F.spark_partition_id()).write.mode("overwrite").partitionBy("range").parquet(f"{path}/pages")
    pages = spark.read.schema(f"{_ddl(rows)}, row bigint, range int").parquet(f"{path}/pages")
    index = pages.groupBy("range", *present(pages, SLICE_DIMS)).agg(F.count(F.lit(1)).alias("posts"))
    index.write.mode("overwrite").parquet(f"{path}/index")
    pages.limit(0).coalesce(1).write.mode("overwrite").parquet(f"{path}/layout")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def load_pages(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``(pages, index)`` as `save_pages` wrote them."""
    layout = spark.read.parquet(f"{path}/layout")
    return spark.read.schema(layout.schema).parquet(f"{path}/pages"), spark.read.parquet(f"{path}/index")


def page_place(index: DataFrame, selection: Selection, first: int, size: int) -> DataFrame:
    """One row: the ranges ``low`` to ``high`` that hold the rows from ``first`` on, and how many rows of the selection lie before ``low``."""
    counts = select_slice(index, selection).groupBy("range").agg(F.sum("posts").alias("posts"))
    # One row per range: a table's worth of folders, not of posts.
    upto = F.sum("posts").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = counts.select("range", (upto - F.col("posts")).alias("before"), upto.alias("upto"))
    holds = placed.filter((F.col("upto") > first) & (F.col("before") < first + size))
    return holds.agg(F.min("range").alias("low"), F.max("range").alias("high"), F.min("before").alias("before"))


def seek_page(pages: DataFrame, index: DataFrame, selection: Selection, page: int = 0, size: int = 10) -> DataFrame:
    """One page of the matching posts, as `explorer.explorer_page` gives it, from the range or two that hold it."""
    first = page * size
    low, high, before = page_place(index, selection, first, size).first()
    shown = _shown(pages)
    if low is None:
        return pages.select(*shown).limit(0)
    rows = select_slice(pages.filter(F.col("range").between(low, high)), selection)
    return rows.orderBy(*_order(pages)).offset(first - before).limit(size).select(*shown)


def _text(column: str) -> Column:
    return F.lower(F.col(column).cast("string"))


def _grams(text: Column) -> Column:
    """Distinct trigrams; none of shorter texts."""
    places = F.when(F.length(text) >= GRAM, F.sequence(F.lit(1), F.length(text) - (GRAM - 1)))
    return F.array_distinct(F.transform(places, lambda i: F.substring(text, i, F.lit(GRAM))))


def save_search(pages: DataFrame, path: str, columns: list[str] | None = None) -> None:
    """Values by column with the ranges they occur in, in sorted blocks, and postings of the blocks' trigrams. ``columns`` default to all that pages show."""
    spark = pages.sparkSession
    columns = columns or _shown(pages)
    cells = F.array(*[F.struct(F.lit(c).alias("column"), _text(c).alias("value")) for c in columns])
    values = pages.select("range", F.explode(cells).alias("cell")).select("cell.*", "range").filter("value IS NOT NULL").distinct()
    block_rows = max(BLOCK_VALUES, math.ceil(pages.count() * len(columns) / MOST_RANGES))
    placed = values.repartitionByRange("column", "value", "range").sortWithinPartitions("column", "value", "range")
    # Row numbers run within a partition, and those of two partitions are far apart.
    blocks = placed.withColumn("row", F.monotonically_increasing_id()).withColumn("block", F.expr(f"row DIV {block_rows}")).drop("row")
    blocks.write.mode("overwrite").partitionBy("column").parquet(f"{path}/values")
    stored = spark.read.schema(VALUES).parquet(f"{path}/values")
    postings = stored.select("column", "block", F.explode(_grams(F.col("value"))).alias("gram")).distinct()
    # In order of trigrams, so that a scan skips the row groups of others.
    postings.hint("rebalance", "column", "gram").sortWithinPartitions("column", "gram").write.mode("overwrite").partitionBy("column").parquet(
        f"{path}/postings"
    )


def load_search(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``(values, postings)`` as `save_search` wrote them."""
    values = spark.read.schema(VALUES).parquet(f"{path}/values")
    return values, spark.read.schema(POSTINGS).parquet(f"{path}/postings")


def _cells_with(values: DataFrame, postings: DataFrame, column: str, term: str) -> DataFrame:
    """The values of a column that contain a term, in any case, and the ranges that they occur in."""
    term = term.lower()
    grams = sorted({term[i : i + GRAM] for i in range(len(term) - GRAM + 1)})
    cells = values.filter(F.col("column") == column)
    if grams:
        hits = postings.filter((F.col("column") == column) & F.col("gram").isin(grams))
        blocks = hits.groupBy("block").agg(F.count(F.lit(1)).alias("grams")).filter(F.col("grams") == len(grams)).select("block")
        # At most MOST_RANGES numbers, and one for each task that wrote values.
        cells = cells.join(F.broadcast(blocks), "block", "left_semi")
    return cells.filter(F.contains("value", F.lit(term))).select("value", "range")


def values_with(values: DataFrame, postings: DataFrame, column: str, term: str) -> DataFrame:
    """The distinct values of a column that contain a term, in any case."""
    return _cells_with(values, postings, column, term).select("value").distinct()


def search_pages(
    pages: DataFrame, search: tuple[DataFrame, DataFrame], selection: Selection, terms: Mapping[str, str], page: int = 0, size: int = 10
) -> DataFrame:
    """One page of the posts whose columns contain the terms, as `explorer.explorer_page` gives it, read from the ranges that hold such values."""
    values, postings = search
    rows = pages
    for column, term in terms.items():
        held = _cells_with(values, postings, column, term).select("range").distinct()
        # At most MOST_RANGES numbers.
        rows = rows.join(F.broadcast(held), "range", "left_semi").filter(F.contains(_text(column), F.lit(term.lower())))
    shown = _shown(pages)
    return select_slice(rows, selection).orderBy(*_order(pages)).offset(page * size).limit(size).select(*shown)
