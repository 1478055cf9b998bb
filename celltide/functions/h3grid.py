"""H3 cells through the optional ``h3`` package (v4 names), Arrow-batched."""

from __future__ import annotations

import importlib
from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_NEEDED = ("latlng_to_cell", "cell_to_latlng", "cell_to_boundary")


def _h3():
    return importlib.import_module("h3")


def available() -> bool:
    """Whether ``h3`` with the v4 names can be imported here."""
    try:
        return all(hasattr(_h3(), name) for name in _NEEDED)
    except ImportError:
        return False


def _known(values: pd.Series, compute: Callable) -> pd.Series:
    """Apply to the distinct known values only: a batch repeats few cells.

    A value outside the grid's domain gives null; a missing package or
    function is an error and stays one.
    """

    def one(value):
        try:
            return compute(value)
        except ValueError:
            return None

    table = {v: one(v) for v in values.dropna().unique()}
    return values.map(table).astype(object).where(values.notna(), None)


@dataclass(frozen=True)
class H3Grid:
    """Same contract as ``HexGrid``, with real H3 ids."""

    resolution: int = 9

    def __post_init__(self) -> None:
        if not available():
            raise ImportError("H3Grid needs the h3 package, version 4, on driver and executors")

    def assign(
        self,
        df: DataFrame,
        lat: str,
        lng: str,
        into: str = "h3_index",
        centre: tuple[str, str] | None = None,
    ) -> DataFrame:
        resolution = self.resolution

        @F.pandas_udf("string")
        def cell_of(lats: pd.Series, lngs: pd.Series) -> pd.Series:
            h3 = _h3()
            points = pd.Series(list(zip(lats, lngs)), dtype=object)
            points = points.where((lats.notna() & lngs.notna()).to_numpy(), None)
            return _known(points, lambda p: h3.latlng_to_cell(p[0], p[1], resolution))

        cells = df.withColumn(into, cell_of(F.col(lat).cast("double"), F.col(lng).cast("double")))
        return self.add_centre(cells, into, *centre) if centre else cells

    def add_centre(self, df: DataFrame, cell: str, lat: str, lng: str) -> DataFrame:
        @F.pandas_udf("struct<lat double, lng double>")
        def centre_of(cells: pd.Series) -> pd.DataFrame:
            centres = _known(cells, _h3().cell_to_latlng)
            pairs = [(None, None) if c is None else c for c in centres]
            return pd.DataFrame(pairs, columns=["lat", "lng"], dtype="float64")

        kept = [c for c in df.columns if c not in (lat, lng)]
        return df.select(*kept, centre_of(F.col(cell)).alias("_centre")).select(
            *kept, F.col("_centre.lat").alias(lat), F.col("_centre.lng").alias(lng)
        )

    def add_outline(self, df: DataFrame, cell: str, into: str = "h3_wkt") -> DataFrame:
        @F.pandas_udf("string")
        def outline_of(cells: pd.Series) -> pd.Series:
            h3 = _h3()

            def wkt(c: str) -> str:
                ring = list(h3.cell_to_boundary(c))
                return f"POLYGON(({', '.join(f'{x} {y}' for y, x in [*ring, ring[0]])}))"

            return _known(cells, wkt)

        return df.withColumn(into, outline_of(F.col(cell)))
