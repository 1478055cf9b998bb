"""The optional backend against a stand-in module with the same three functions."""

import sys
import textwrap

import pytest

from celltide.functions import h3grid

STAND_IN = textwrap.dedent(
    """
    def latlng_to_cell(lat, lng, resolution):
        if abs(lat) > 90:
            raise ValueError("latitude")
        return f"{resolution}:{round(lat)}:{round(lng)}"

    def cell_to_latlng(cell):
        _, lat, lng = cell.split(":")
        return float(lat), float(lng)

    def cell_to_boundary(cell):
        lat, lng = cell_to_latlng(cell)
        return ((lat + 1, lng), (lat, lng - 1), (lat, lng + 1))
    """
)


@pytest.fixture
def h3(spark, tmp_path, monkeypatch):
    module = tmp_path / "h3.py"
    module.write_text(STAND_IN)
    monkeypatch.syspath_prepend(str(tmp_path))
    spark.sparkContext.addPyFile(str(module))
    yield
    sys.modules.pop("h3", None)


def test_same_contract_as_the_native_grid(spark, h3):
    grid = h3grid.H3Grid()
    df = spark.createDataFrame(
        [(21.5, 105.8), (21.5, 105.8), (None, 1.0), (1.0, None), (99.0, 1.0)],
        "lat double, lng double",
    )
    got = grid.assign(df, "lat", "lng")
    got = grid.add_centre(got, "h3_index", "clat", "clng")
    got = grid.add_outline(got, "h3_index")
    wkt = "POLYGON((106.0 23.0, 105.0 22.0, 107.0 22.0, 106.0 23.0))"
    known = (21.5, 105.8, "9:22:106", 22.0, 106.0, wkt)
    assert [tuple(r) for r in got.collect()] == [
        known, known,
        (None, 1.0, None, None, None, None),
        (1.0, None, None, None, None, None),
        (99.0, 1.0, None, None, None, None),
    ]


def test_a_missing_package_is_an_error_not_a_null(monkeypatch):
    monkeypatch.setitem(sys.modules, "h3", None)
    assert not h3grid.available()
    with pytest.raises(ImportError):
        h3grid.H3Grid()
