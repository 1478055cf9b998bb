"""Hexagonal grid: position to cell id, cell id to centre and outline.

``HexGrid`` is the default. It works on a cylindrical equal-area plane with
built-in expressions only, so a scan, the grid and the aggregate behind it
share one generated stage, and cells have the same area at every latitude.
Its ids are its own: not H3 ids. ``celltide.functions.h3grid`` has the same
three methods over the ``h3`` package where that is installed.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from celltide.functions.geo import EARTH_RADIUS_KM


class Grid(Protocol):
    def assign(
        self,
        df: DataFrame,
        lat: str,
        lng: str,
        into: str = "h3_index",
        centre: tuple[str, str] | None = None,
    ) -> DataFrame:
        """Add the id of the cell that holds each position, and its ``centre`` as two doubles.

        Nulls for a position that is null, no number, infinite, or beyond the
        poles; a longitude may go round the globe more than once.
        """

    def add_centre(self, df: DataFrame, cell: str, lat: str, lng: str) -> DataFrame:
        """Add the centre of each cell as two doubles."""

    def add_outline(self, df: DataFrame, cell: str, into: str = "h3_wkt") -> DataFrame:
        """Add each cell's closed outline as WKT, longitude first."""


@dataclass(frozen=True)
class HexGrid:
    """Pointy-top axial hexagons.

    ``edge_km`` defaults to the mean edge of H3 resolution 9, so densities are
    comparable in size. ``parallel_deg`` is the latitude without distortion.
    """

    edge_km: float = 0.200786
    parallel_deg: float = 16.0
    prefix: str = "hx9"

    @property
    def _shrink(self) -> float:
        return math.cos(math.radians(self.parallel_deg))

    def assign(
        self,
        df: DataFrame,
        lat: str,
        lng: str,
        into: str = "h3_index",
        centre: tuple[str, str] | None = None,
    ) -> DataFrame:
        # comparisons with NaN as the larger value are false
        on_globe = (F.abs(F.col(lat)) <= 90.0) & (F.abs(F.col(lng)) < math.inf)
        turned = F.pmod(F.col(lng) + 180.0, F.lit(360.0)) - 180.0
        wrapped = F.when((F.col(lng) >= -180.0) & (F.col(lng) < 180.0), F.col(lng)).otherwise(turned)
        x = F.radians(F.when(on_globe, wrapped)) * (EARTH_RADIUS_KM * self._shrink)
        y = F.sin(F.radians(F.when(on_globe, F.col(lat)))) * (EARTH_RADIUS_KM / self._shrink)
        kept = df.columns
        # Layered selects: each value is computed once and reused by the next layer.
        fractional = df.select(
            *kept,
            ((x * (math.sqrt(3.0) / 3.0) - y / 3.0) / self.edge_km).alias("_fq"),
            (y * (2.0 / 3.0) / self.edge_km).alias("_fr"),
        )
        rounded = fractional.select(
            *kept,
            "_fq",
            "_fr",
            F.floor(F.col("_fq") + 0.5).alias("_rq"),
            F.floor(F.col("_fr") + 0.5).alias("_rr"),
            F.floor(0.5 - F.col("_fq") - F.col("_fr")).alias("_rs"),
        )
        errors = rounded.select(
            *kept,
            "_rq",
            "_rr",
            "_rs",
            F.abs(F.col("_rq") - F.col("_fq")).alias("_dq"),
            F.abs(F.col("_rr") - F.col("_fr")).alias("_dr"),
            F.abs(F.col("_rs") + F.col("_fq") + F.col("_fr")).alias("_ds"),
        )
        # q + r + s = 0 must hold; the component with the largest error gives way.
        q_worst = (F.col("_dq") > F.col("_dr")) & (F.col("_dq") > F.col("_ds"))
        r_worst = F.col("_dr") > F.col("_ds")
        q = F.when(q_worst, -F.col("_rr") - F.col("_rs")).otherwise(F.col("_rq"))
        r = F.when(~q_worst & r_worst, -F.col("_rq") - F.col("_rs")).otherwise(F.col("_rr"))
        axial = errors.select(*kept, q.alias("_q"), r.alias("_r"))
        parts = (F.col("_q").cast("string"), F.col("_r").cast("string"))
        cell = F.concat_ws("_", F.lit(self.prefix), *parts)
        known = F.col("_q").isNotNull() & F.col("_r").isNotNull()
        others = [c for c in kept if c != into and c not in (centre or ())]
        added = [F.when(known, cell).alias(into)]
        if centre:  # from the numbers, without reading them back out of the id
            x, y = self._centre_on_plane()
            added += [self._lat(y).alias(centre[0]), self._lng(x).alias(centre[1])]
        return axial.select(*others, *added)

    def axial(self, cell: Column) -> tuple[Column, Column]:
        """The (q, r) pair inside an id, as longs; null for a foreign id."""
        ours = F.when(cell.startswith(self.prefix + "_"), cell)
        return (
            F.split_part(ours, F.lit("_"), F.lit(2)).try_cast("bigint"),
            F.split_part(ours, F.lit("_"), F.lit(3)).try_cast("bigint"),
        )

    def _centre_on_plane(self) -> tuple[Column, Column]:
        x = (F.col("_q") + F.col("_r") / 2.0) * (math.sqrt(3.0) * self.edge_km)
        return x, F.col("_r") * (1.5 * self.edge_km)

    def _plane(self, df: DataFrame, cell: str) -> DataFrame:
        q, r = self.axial(F.col(cell))
        axial = df.select("*", q.alias("_q"), r.alias("_r"))
        x, y = self._centre_on_plane()
        return axial.select(*df.columns, x.alias("_x"), y.alias("_y"))

    def _lng(self, x: Column) -> Column:
        return F.degrees(x / (EARTH_RADIUS_KM * self._shrink))

    def _lat(self, y: Column) -> Column:
        return F.degrees(F.asin(y * (self._shrink / EARTH_RADIUS_KM)))

    def add_centre(self, df: DataFrame, cell: str, lat: str, lng: str) -> DataFrame:
        others = [c for c in df.columns if c not in (lat, lng)]
        return self._plane(df.select(*others), cell).select(
            *others, self._lat(F.col("_y")).alias(lat), self._lng(F.col("_x")).alias(lng)
        )

    def add_outline(self, df: DataFrame, cell: str, into: str = "h3_wkt") -> DataFrame:
        corners = []
        # six corners counter-clockwise from the northernmost, the first one twice
        for k in [0, 1, 2, 3, 4, 5, 0]:
            turn = math.radians(-60.0 * k)
            lng = self._lng(F.col("_x") + self.edge_km * math.sin(turn))
            lat = self._lat(F.col("_y") + self.edge_km * math.cos(turn))
            corners.append(F.format_string("%.7f %.7f", lng, lat))
        ring = F.concat(F.lit("POLYGON(("), F.concat_ws(", ", *corners), F.lit("))"))
        others = [c for c in df.columns if c != into]
        return self._plane(df.select(*others), cell).select(
            *others, F.when(F.col("_x").isNotNull(), ring).alias(into)
        )
