"""Enrichment: grid cell, serving site, estimated site positions, distance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from celltide.functions.geo import haversine_km, law_of_cosines_km
from celltide.functions.grid import Grid, HexGrid
from celltide.operators.joins import (
    Lookup,
    broadcast_limit,
    left_lookup,
    staged_lookup,
    unique_lookup,
)
from celltide.schemas import BATCH_KEYS
from celltide.sources.workspace import Workspace

CENTROID_KEYS = (*BATCH_KEYS, "cell_id")


def cell_sites(cell_info: DataFrame) -> DataFrame:
    """The cell master under our names. Its ``x_`` is the latitude."""
    sites = cell_info.select(
        F.col("cell_code").alias("cell_id"),
        F.col("x_").alias("cell_lat"),
        F.col("y_").alias("cell_lon"),
    )
    return typed_positions(sites, "cell_lat", "cell_lon")


def typed_positions(df: DataFrame, *columns: str) -> DataFrame:
    """Coordinates as doubles; text that is no number becomes null."""
    return df.withColumns({c: F.col(c).try_cast("double") for c in columns})


def site_lookup(cell_info: DataFrame) -> Lookup:
    """The cell master, measured, with one row per cell or an error."""
    return unique_lookup(cell_sites(cell_info), "cell_id")


def attach_sites(df: DataFrame, sites: Lookup) -> DataFrame:
    """Left join with the master: unknown and null cells keep a null position."""
    return left_lookup(df, sites)


def unmatched_cells(df: DataFrame, cell_info: DataFrame) -> DataFrame:
    """Cells that are measured but missing from the master, with their rows."""
    # aggregate first: the anti join then sees one row per cell, whatever its share
    seen = df.filter(F.col("cell_id").isNotNull()).groupBy("cell_id").agg(
        F.count(F.lit(1)).alias("samples")
    )
    return seen.join(cell_sites(cell_info).select("cell_id"), "cell_id", "left_anti")


def cell_centroids(df: DataFrame) -> DataFrame:
    """Mean position of each cell's measurements in each batch.

    Equals an average over a window per cell, without moving a cell's rows to
    one task: the averages combine before the shuffle. Rows without a cell
    form one group.
    """
    return df.groupBy(*CENTROID_KEYS).agg(*_means())


def _means() -> tuple[Column, Column]:
    return F.avg("lat").alias("est_cell_lat"), F.avg("lng").alias("est_cell_lon")


def cell_positions(df: DataFrame, sites: Lookup, workspace: Workspace) -> Lookup:
    """Position and source of every cell of every batch that occurs, and its number of rows ``n``.

    Each coordinate comes from the master, or else is the mean of the cell's
    measurements; the source is ``estimated`` if one of the two is. Rows
    without a cell share one estimate. Measurements are aggregated before they
    meet the master, so neither the size of the master nor a crowded cell
    matters here, and they take part in one join only, the one with the result.
    """
    cells = df.groupBy(*CENTROID_KEYS).agg(*_means(), F.count(F.lit(1)).alias("n"))
    unknown = F.col("cell_lat").isNull() | F.col("cell_lon").isNull()
    placed = cells.join(sites.df, "cell_id", "left").select(
        *CENTROID_KEYS,
        F.coalesce("cell_lat", "est_cell_lat").alias("cell_lat"),
        F.coalesce("cell_lon", "est_cell_lon").alias("cell_lon"),
        F.when(unknown, F.lit("estimated")).otherwise(F.lit("master")).alias("cell_pos_source"),
        "n",
    )
    return staged_lookup(placed, CENTROID_KEYS, workspace, "positions")


def attach_positions(df: DataFrame, positions: Lookup) -> DataFrame:
    """Every measurement with the position and source of its cell."""
    return left_lookup(df, positions, null_safe=True, weight="n")


def add_distance(df: DataFrame, method: str = "haversine") -> DataFrame:
    """Distance phone to site in km, by ``haversine`` or ``law_of_cosines``."""
    formula = {"haversine": haversine_km, "law_of_cosines": law_of_cosines_km}[method]
    ends = [F.col(c) for c in ("lat", "lng", "cell_lat", "cell_lon")]
    return df.withColumn("distance_to_cell_km", formula(*ends))


def scatters(df: DataFrame, positions: Lookup) -> bool:
    """Whether enriching shuffles the measurements, as positions are too large to broadcast."""
    return not positions.fits(broadcast_limit(df))


def enrich(
    clean: DataFrame,
    positions: Lookup,
    grid: Grid = HexGrid(),
    method: str = "haversine",
    centre: tuple[str, str] | None = None,
) -> DataFrame:
    """Clean measurements with site position, distance and grid cell, and its ``centre`` if asked for.

    ``clean`` should come from a scan: see ``with_salt``.
    """
    placed = add_distance(attach_positions(clean, positions), method)
    return grid.assign(placed, "lat", "lng", centre=centre)
