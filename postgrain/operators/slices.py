"""Slice-and-dice: reports for any selection of type, account kind and category.

A selection maps dimensions to one value each; a dimension that is absent or None is
not filtered. ``select_slice`` works on posts, on the filter cube and on samples.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from postgrain import functions as fx
from postgrain.operators import topk
from postgrain.schema import SLICE_DIMS, present, user_column

Selection = Mapping[str, object]

# Additive measures: their sums over cube rows equal those over the posts.
SUMMED = {
    "likes": "likes", "comments": "comments", "engagement": "engagement",
    "followers": "followers", "rate": "engagement_rate",
}


def in_slice(df: DataFrame, selection: Selection, except_dim: str | None = None) -> Column:
    """Whether a row matches the selection, ignoring the chart's own dimension."""
    match = F.lit(True)
    for dim in present(df, SLICE_DIMS):
        value = selection.get(dim)
        if value is not None and dim != except_dim:
            match = match & (F.col(dim) == F.lit(value))
    return match


def select_slice(df: DataFrame, selection: Selection, except_dim: str | None = None) -> DataFrame:
    return df.filter(in_slice(df, selection, except_dim))


def filter_cube(posts: DataFrame, *also: str) -> DataFrame:
    """Counts and sums per (type, business, category), and per columns ``also``: a few dozen rows.

    Each sum comes with the number of values in it, so that an average over any
    selection skips missing values just as an average over the posts does.
    """
    measures = [
        fn(col).alias(f"{prefix}_{name}")
        for name, col in SUMMED.items() if col in posts.columns
        for prefix, fn in (("sum", F.sum), ("cnt", F.count))
    ]
    return posts.groupBy(*also, "post_type", *SLICE_DIMS).agg(
        F.count(F.lit(1)).alias("post_count"), *measures
    )


def merged_cube(parts: DataFrame) -> DataFrame:
    """One cube from the rows of cubes of parts of the posts."""
    return parts.groupBy("post_type", *SLICE_DIMS).agg(*_merged(parts))


def _merged(cube: DataFrame) -> list[Column]:
    """Re-summed measures of cube rows, for ``agg``."""
    sums = [c for c in cube.columns if c.startswith(("sum_", "cnt_"))]
    return [
        F.coalesce(F.sum("post_count"), F.lit(0)).alias("post_count"),
        *[F.sum(c).alias(c) for c in sums],
    ]


def _ratios(merged: DataFrame) -> list[Column]:
    """Averages from merged measures; NULL when there is nothing to average."""
    names = [n for n in SUMMED if f"sum_{n}" in merged.columns]
    return [F.try_divide(f"sum_{n}", f"cnt_{n}").alias(f"avg_{n}") for n in names]


def slice_kpis(cube: DataFrame, selection: Selection) -> DataFrame:
    """Post count and averages of one selection, one row."""
    merged = select_slice(cube, selection).agg(*_merged(cube))
    return merged.select("post_count", *_ratios(merged))


def slice_kpis_cube(cube: DataFrame) -> DataFrame:
    """The KPIs of every possible selection.

    ``all_<dim>`` tells "not filtered" from a NULL value. The grouping sets expand the
    few rows of the filter cube, not the posts.
    """
    flags = [F.grouping(d).cast("boolean").alias(f"all_{d}") for d in SLICE_DIMS]
    merged = cube.cube(*SLICE_DIMS).agg(*_merged(cube), *flags)
    return merged.select(
        *SLICE_DIMS, *[f"all_{d}" for d in SLICE_DIMS], "post_count", *_ratios(merged)
    )


def covering_selections(cell: Column | DataFrame) -> Column:
    """All selections that a cell belongs to: each dimension either filtered or not."""
    picks = []
    for mask in range(2 ** len(SLICE_DIMS)):
        fields = []
        for bit, dim in enumerate(SLICE_DIMS):
            every = bool(mask >> bit & 1)
            value = F.when(F.lit(not every), cell[dim])
            fields += [value.alias(dim), F.lit(every).alias(f"all_{dim}")]
        picks.append(F.struct(*fields))
    return F.array(*picks)


def slice_unique_users(posts: DataFrame) -> DataFrame:
    """Exact distinct users of every possible selection.

    Distinct counts do not add up over cube rows. Each user's cells are made distinct first, by a
    hash aggregate in the map tasks, so a very active user is as cheap as any other; the sets are
    built from these pairs alone. Users with the same set count alike, so from then
    on there are only the different sets, with their numbers of users: such a set adds its
    number to each selection that covers one of its cells.
    """
    user = user_column(posts)
    sets = (
        posts.select(user, *SLICE_DIMS).distinct()
        .groupBy(user).agg(F.collect_list(F.struct(*SLICE_DIMS)).alias("cells"))
        .select(F.sort_array("cells").alias("cells"))
        .groupBy("cells").agg(F.count(F.lit(1)).alias("n"))
    )
    covered = F.array_distinct(F.flatten(F.transform("cells", covering_selections)))
    return (
        sets.select("n", F.explode(covered).alias("s")).select("n", "s.*")
        .groupBy(*SLICE_DIMS, *[f"all_{d}" for d in SLICE_DIMS])
        .agg(F.sum("n").alias("unique_users"))
    )


def _by_dim(cube: DataFrame, selection: Selection, dim: str) -> DataFrame:
    """Merged measures per value of ``dim``, under the filters on the other dimensions."""
    rows = select_slice(cube, selection, except_dim=dim).filter(F.col(dim).isNotNull())
    return rows.groupBy(dim).agg(*_merged(cube))


def slice_posts_by_type(cube: DataFrame, selection: Selection) -> DataFrame:
    dim = "post_type_label"
    return _by_dim(cube, selection, dim).select(dim, "post_count").orderBy(dim)


def slice_posts_by_category(
    cube: DataFrame, selection: Selection, k: int = topk.TOP_CATEGORIES
) -> DataFrame:
    return topk.top_categories(_by_dim(cube, selection, "description_category"), k)


def slice_engagement_by_category(
    cube: DataFrame, selection: Selection, k: int = topk.TOP_ENGAGING_CATEGORIES
) -> DataFrame:
    merged = _by_dim(cube, selection, "description_category")
    means = merged.select("description_category", *_ratios(merged))
    return topk.most_engaging_categories(means, k)


def slice_engagement_by_business(cube: DataFrame, selection: Selection) -> DataFrame:
    merged = _by_dim(cube, selection, "is_business_account")
    account = fx.account_label(F.col("is_business_account")).alias("account")
    return merged.select(account, *_ratios(merged)).select("account", "avg_engagement").orderBy(
        "account"
    )


def slice_top_users(
    posts: DataFrame, selection: Selection, k: int = topk.TOP_USERS
) -> DataFrame:
    """The users with the most engagement in a selection, from the posts themselves.

    Merging the per-cell lists of ``top_users_cube`` would miss users who are spread
    over several cells. Without filters this is ``top_users_by_engagement``.
    """
    return topk.top_users_by_engagement(select_slice(posts, selection), k)


def facet_values(cube: DataFrame, categories: int | None = None) -> DataFrame:
    """Filter choices ``(facet, choice)`` from the filter cube: all type labels, and all categories
    or the first ``categories`` by name."""
    both = F.array(*[
        F.struct(F.lit(facet).alias("facet"), F.col(facet).alias("choice"))
        for facet in ("post_type_label", "description_category")
    ])
    choices = (
        cube.select(F.explode(both).alias("c")).select("c.*").distinct()
        .filter((F.col("facet") == "post_type_label") | F.col("choice").isNotNull())
    )
    if categories is not None:
        by_name = Window.partitionBy("facet").orderBy("choice")
        choices = choices.withColumn("n", F.row_number().over(by_name)).filter(
            (F.col("facet") == "post_type_label") | (F.col("n") <= categories)
        ).drop("n")
    return choices.orderBy("facet", "choice")
