"""Distinct users and medians of any selection from sketches per cell of the filter cube, without reading the posts.

Counts and sums add up over cells; distinct counts and medians don't. Sketches do: HyperLogLog for users, KLL for medians. They are
built in the map tasks, one row per cell, stored, and merged for any selection. Their size depends on their accuracy alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postgrain.operators.slices import Selection, select_slice
from postgrain.schema import SLICE_DIMS, present, user_column

# 2**14 registers; the relative standard error of a count is 1.04 / sqrt(registers).
LOG_REGISTERS = 14
USER_ERROR = 1.04 / 2 ** (LOG_REGISTERS / 2)
# Size parameter of the quantile sketches; the rank of a quantile errs by no more than this share of the values in 99 of 100 cases.
QUANTILE_SIZE = 2048
RANK_ERROR = 2.296 / QUANTILE_SIZE**0.9021
MEASURES = ["likes", "comments"]


def cell_sketches(posts: DataFrame) -> DataFrame:
    """One row per cell: ``users`` sketch, and ``n_<measure>`` with the ``q_<measure>`` sketch of its values."""
    values = [
        c for m in present(posts, MEASURES) for c in (
            F.count(m).alias(f"n_{m}"), F.kll_sketch_agg_double(m, F.lit(QUANTILE_SIZE)).alias(f"q_{m}")
        )
    ]
    users = F.hll_sketch_agg(user_column(posts), F.lit(LOG_REGISTERS)).alias("users")
    return posts.groupBy(*present(posts, SLICE_DIMS)).agg(users, *values)


def _measures(sketches: DataFrame) -> list[str]:
    return [c.removeprefix("q_") for c in sketches.columns if c.startswith("q_")]


def _merged(sketches: DataFrame) -> list:
    """Merged sketches of cell rows, for ``agg``."""
    out = [F.hll_union_agg("users").alias("users")]
    for m in _measures(sketches):
        out += [F.sum(f"n_{m}").alias(f"n_{m}"), F.kll_merge_agg_double(f"q_{m}").alias(f"q_{m}")]
    return out


def _estimates(merged: DataFrame) -> list:
    """What merged sketches say; a median of no values is NULL."""
    out = [F.hll_sketch_estimate("users").alias("unique_users")]
    for m in _measures(merged):
        middle = F.kll_sketch_get_quantile_double(f"q_{m}", F.lit(0.5))
        out += [F.when(F.col(f"n_{m}") > 0, middle).alias(f"median_{m}")]
    return out


def slice_estimates(sketches: DataFrame, selection: Selection) -> DataFrame:
    """About how many users a selection has, and about their medians: one row."""
    merged = select_slice(sketches, selection).agg(*_merged(sketches))
    return merged.select(*_estimates(merged))


def slice_estimates_cube(sketches: DataFrame) -> DataFrame:
    """The estimates of every possible selection; ``all_<dim>`` tells "not filtered" from a NULL value."""
    dims = present(sketches, SLICE_DIMS)
    flags = [F.grouping(d).cast("boolean").alias(f"all_{d}") for d in dims]
    merged = sketches.cube(*dims).agg(*_merged(sketches), *flags)
    return merged.select(*dims, *[f"all_{d}" for d in dims], *_estimates(merged))
