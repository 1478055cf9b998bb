"""Rows as the serving database and the map take them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from celltide.functions.grid import Grid, HexGrid
from celltide.schemas import RadioDomain

# The map's sequential colour scale, weakest class first.
SIGNAL_COLOURS = ("#5A1846", "#900C3F", "#C70039", "#E3611C", "#F1920E", "#FFC300")


def record_time() -> Column:
    """The start of a batch's hour."""
    stamp = F.concat(F.col("date"), F.lit(" "), F.col("hour"), F.lit(":00:00"))
    return F.to_timestamp(stamp, "yyyy-MM-dd HH:mm:ss").alias("record_time")


def spatial_rows(gold: DataFrame, grid: Grid = HexGrid()) -> DataFrame:
    """Gold rows with the outline of their grid cell."""
    return grid.add_outline(gold, "h3_index")


def map_rows(gold: DataFrame) -> DataFrame:
    """The map's columns, for whatever batches ``gold`` holds."""
    return gold.select(
        "h3_index",
        "cell_id",
        "cell_lat",
        "cell_lon",
        "h3_center_lat",
        "h3_center_lon",
        F.col("user_density_count").alias("user_density"),
        "avg_rsrp",
        record_time(),
    )


def map_day(gold: DataFrame, date: str) -> DataFrame:
    """One day for the map, by hour.

    The further sort columns let a crowded hour spread over many tasks.
    """
    day = map_rows(gold.filter(F.col("date") == date))
    return day.orderBy("record_time", "h3_index", "cell_id")


def audit_day(report: DataFrame, date: str) -> DataFrame:
    """One day of audit rows, by hour."""
    return report.filter(F.col("date") == date).orderBy("hour")


def between_times(gold: DataFrame, first: str, last: str) -> DataFrame:
    """Batches starting in a closed time range, given as ``YYYY-MM-DD HH:MM:SS``.

    The range of days is repeated on ``date`` so that partitions are pruned.
    """
    return gold.filter(
        F.col("date").between(first[:10], last[:10])
        & record_time().between(F.lit(first).cast("timestamp"), F.lit(last).cast("timestamp"))
    )


def arcs(map_df: DataFrame) -> DataFrame:
    """Arcs from a site to the centre of a grid cell it serves; both ends known."""
    return map_df.select(
        F.col("cell_lat").alias("lat0"),
        F.col("cell_lon").alias("lng0"),
        F.col("h3_center_lat").alias("lat1"),
        F.col("h3_center_lon").alias("lng1"),
        "user_density",
        "avg_rsrp",
        "record_time",
    ).dropna(subset=["lat0", "lng0", "lat1", "lng1"])


def signal_class(signal: Column, domain: RadioDomain = RadioDomain()) -> Column:
    """Class 1 (weakest) to 6 of equal width over the valid range, ends included."""
    low, high = (float(v) for v in domain.rsrp)
    classes = len(SIGNAL_COLOURS)
    bucket = F.width_bucket(signal, F.lit(low), F.lit(high), F.lit(classes)).cast("int")
    inside = F.when(bucket > classes, classes).when(bucket < 1, 1).otherwise(bucket)
    return inside.alias("signal_class")


def with_signal_class(map_df: DataFrame, domain: RadioDomain = RadioDomain()) -> DataFrame:
    scale = F.array(*[F.lit(c) for c in SIGNAL_COLOURS])
    classed = map_df.select("*", signal_class(F.col("avg_rsrp"), domain))
    return classed.withColumn("signal_colour", F.get(scale, F.col("signal_class") - 1))
