"""Quantiles of columns with any number of values, by mergeable sketches.

``percentile_disc`` keeps a count per distinct value, which is bounded for
RSRP alone. A KLL sketch keeps some hundred values per group whatever the
column, and sketches of hours merge into those of days. Its rank is off by
``rank_error`` at most, in all but one of a hundred quantiles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Values kept per level.
K = 400


def rank_error(k: int = K) -> float:
    """The share of rows by which the rank of one quantile is off at most, with 99 % confidence.

    Fixed values: the published fit of the sketch's normalised rank error.
    """
    return 2.296 / k**0.9021


def sketch(column: str, k: int = K) -> Column:
    """Aggregate: the sketch of a numeric column; nulls are passed over."""
    return F.kll_sketch_agg_double(F.col(column).cast("double"), F.lit(k))


def sketches(df: DataFrame, keys: Sequence[str], column: str, k: int = K) -> DataFrame:
    """``keys, n, sketch`` per group: partial sketches of tasks merge, rows are not shuffled."""
    return df.groupBy(*keys).agg(F.count(column).alias("n"), sketch(column, k).alias("sketch"))


def merged(stored: DataFrame, keys: Sequence[str], k: int = K) -> DataFrame:
    """Sketches of coarser groups from those of finer ones."""
    return stored.groupBy(*keys).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))


def quantile(share: float, name: str) -> Column:
    """The value at a share of a group's rows; null for a group without values."""
    found = F.kll_sketch_get_quantile_double(F.col("sketch"), F.lit(share))
    return F.when(F.col("n") > 0, found).alias(name)
