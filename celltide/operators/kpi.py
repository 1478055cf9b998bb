"""Coverage indicators per grid cell and serving cell, and their roll-ups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from celltide.functions.grid import Grid, HexGrid
from celltide.schemas import BATCH_KEYS, RadioDomain

GOLD_KEYS = (*BATCH_KEYS, "h3_index", "cell_id")


def samples() -> Column:
    """Measurements, not distinct phones: a row names no user."""
    return F.count(F.lit(1)).alias("user_density_count")


def mean_signal() -> Column:
    return F.round(F.avg("p_cell_rsrp"), 2).alias("avg_rsrp")


def weakest_tenth() -> Column:
    """Tenth percentile of RSRP, always a measured value.

    Exact: it keeps a count per distinct value, and RSRP has 97 of them in its
    valid range, so the state stays small however many rows a group has.
    """
    rank = F.expr("percentile_disc(0.1) WITHIN GROUP (ORDER BY p_cell_rsrp)")
    return rank.cast("int").alias("p10_rsrp")


def mean_distance() -> Column:
    return F.round(F.avg("distance_to_cell_km"), 2).alias("avg_distance_km")


def weak_share(domain: RadioDomain = RadioDomain()) -> Column:
    """Share of samples under the weak limit; an unknown signal is not weak."""
    weak = F.when(F.col("p_cell_rsrp") < domain.weak_below_rsrp, 1).otherwise(0)
    return F.round(F.avg(weak), 4).alias("weak_signal_ratio")


def _aggregated(df: DataFrame, keys: Sequence[str], *aggregates: Column) -> DataFrame:
    """Group by the keys, led by their hash.

    An aggregate with object state sorts its input once a task has many groups,
    by the grouping columns in turn. Dates and hours hardly differ within a
    task; a hash in front settles nearly every comparison at once.
    """
    hashed = df.withColumn("_hash", F.xxhash64(*keys))
    return hashed.groupBy("_hash", *keys).agg(*aggregates).drop("_hash")


def indicators(
    enriched: DataFrame, keys: Sequence[str], domain: RadioDomain = RadioDomain()
) -> DataFrame:
    """The five indicators for any grouping of enriched measurements."""
    return _aggregated(
        enriched,
        keys,
        samples(),
        mean_signal(),
        weakest_tenth(),
        mean_distance(),
        weak_share(domain),
    )


def gold(
    enriched: DataFrame, grid: Grid = HexGrid(), domain: RadioDomain = RadioDomain()
) -> DataFrame:
    """The gold table: indicators with the centre of the grid cell and the site.

    The site is constant within a group, so any of its rows would do and
    ``max`` gives the same one every time. The centre follows from the id, so
    it is computed once per group instead of being carried by each row.
    """
    grouped = _aggregated(
        enriched,
        GOLD_KEYS,
        samples(),
        mean_signal(),
        weakest_tenth(),
        mean_distance(),
        weak_share(domain),
        F.max("cell_lat").alias("cell_lat"),
        F.max("cell_lon").alias("cell_lon"),
    )
    return grid.add_centre(grouped, "h3_index", "h3_center_lat", "h3_center_lon")


def by_hex(enriched: DataFrame, domain: RadioDomain = RadioDomain()) -> DataFrame:
    return indicators(enriched, (*BATCH_KEYS, "h3_index"), domain)


def by_cell(enriched: DataFrame, domain: RadioDomain = RadioDomain()) -> DataFrame:
    return indicators(enriched, (*BATCH_KEYS, "cell_id"), domain)
