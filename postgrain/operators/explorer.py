"""Row explorer over the posts, or a sample of them: filters, column search, pages."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postgrain.operators.slices import Selection, in_slice, select_slice
from postgrain.schema import EXPLORER_COLUMNS, present


def _matching(posts: DataFrame, selection: Selection, search: Mapping[str, str]) -> DataFrame:
    rows = select_slice(posts, selection)
    for column, text in search.items():
        rows = rows.filter(F.contains(
            F.lower(F.col(column).cast("string")), F.lit(text.lower())
        ))
    return rows


def explorer_page(
    posts: DataFrame,
    selection: Selection,
    search: Mapping[str, str] | None = None,
    page: int = 0,
    size: int = 10,
) -> DataFrame:
    """One page of the matching rows, in post order.

    ``search`` maps columns to text that must occur in them, in any case.
    """
    first = page * size
    rows = _matching(posts, selection, search or {})
    kept = present(rows, EXPLORER_COLUMNS) or rows.columns
    order = [*present(rows, ["sid", "post_id"]), *kept]
    return rows.orderBy(*dict.fromkeys(order)).offset(first).limit(size).select(*kept)


def explorer_match_count(posts: DataFrame, selection: Selection) -> DataFrame:
    """Matching rows and all rows, one row."""
    return posts.agg(
        F.count_if(in_slice(posts, selection)).alias("matching_rows"),
        F.count(F.lit(1)).alias("all_rows"),
    )


def explorer_by_type(posts: DataFrame, selection: Selection) -> DataFrame:
    """Matching rows per type label."""
    rows = select_slice(posts, selection)
    return rows.groupBy("post_type_label").agg(F.count(F.lit(1)).alias("posts")).orderBy(
        "post_type_label"
    )
