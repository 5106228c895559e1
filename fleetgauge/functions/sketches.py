"""Mergeable quantiles: sketches of a day's values that add up to those of a month.

The sketch is Spark's KLL sketch of integers. A quantile taken from it is one of the values, not interpolated, and its
rank is off by a small share of all values that depends on the sketch size alone, however many days are merged.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Entries of a sketch's lowest levels; about 8 KB for bigint values once it is full.
SIZE = 1_024


def rank_error(size: int = SIZE) -> float:
    """Share of all values by which a quantile's rank is off at most, in 99 of 100 sketches."""
    return 2.296 / size**0.9723


def sketched(value: Column | str, size: int = SIZE) -> Column:
    """Sketch of an integer column; NULLs are left out."""
    return F.kll_sketch_agg_bigint(value if isinstance(value, Column) else F.col(value), size)


def merged(sketch: str, size: int = SIZE) -> Column:
    return F.kll_merge_agg_bigint(sketch, size)


def quantile(sketch: Column | str, fraction: float) -> Column:
    """The value at that fraction of the ranks; NULL without values."""
    column = F.col(sketch) if isinstance(sketch, str) else sketch
    return F.when(F.kll_sketch_get_n_bigint(column) > 0, F.kll_sketch_get_quantile_bigint(column, F.lit(fraction)))
