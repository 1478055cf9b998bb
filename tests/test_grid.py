import math
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from celltide.functions.geo import haversine_km, law_of_cosines_km
from celltide.functions.grid import HexGrid

GRID = HexGrid()
POINTS = st.lists(
    st.tuples(st.floats(-80.0, 80.0), st.floats(-179.0, 179.0)), min_size=1, max_size=50
)


def _points(spark, points):
    return spark.createDataFrame([(float(a), float(b)) for a, b in points], "lat double, lng double")


def _plane(lat, lng):
    shrink = math.cos(math.radians(16.0))
    return (
        6371.0 * shrink * math.radians(lng),
        6371.0 / shrink * math.sin(math.radians(lat)),
    )


@settings(max_examples=8, deadline=None)
@given(points=POINTS)
def test_each_point_belongs_to_its_nearest_centre(spark, points):
    cells = GRID.assign(_points(spark, points), "lat", "lng")
    q, r = GRID.axial(F.col("h3_index"))
    located = GRID.add_centre(cells, "h3_index", "clat", "clng").select("*", q.alias("q"), r.alias("r"))
    for row in located.collect():
        x, y = _plane(row.lat, row.lng)
        gap = math.dist((x, y), _plane(row.clat, row.clng))
        assert gap <= GRID.edge_km + 1e-6
        for dq, dr in [(1, 0), (-1, 0), (0, 1), (0, -1), (1, -1), (-1, 1)]:
            nq, nr = row.q + dq, row.r + dr
            other = (
                GRID.edge_km * math.sqrt(3.0) * (nq + nr / 2.0),
                GRID.edge_km * 1.5 * nr,
            )
            assert gap <= math.dist((x, y), other) + 1e-6


@settings(max_examples=8, deadline=None)
@given(points=POINTS)
def test_the_centre_lies_in_its_cell(spark, points):
    cells = GRID.assign(_points(spark, points), "lat", "lng")
    centred = GRID.add_centre(cells, "h3_index", "lat", "lng").collect()
    centres = spark.createDataFrame(centred, "h3_index string, lat double, lng double")
    again = GRID.assign(centres, "lat", "lng", into="again")
    assert all(r.h3_index == r.again for r in again.collect())


def test_unknown_positions_have_no_cell(spark):
    df = spark.createDataFrame([(None, 1.0), (1.0, None), (None, None)], "lat double, lng double")
    got = GRID.assign(df, "lat", "lng")
    got = GRID.add_centre(got, "h3_index", "clat", "clng")
    got = GRID.add_outline(got, "h3_index")
    for row in got.collect():
        assert (row.h3_index, row.clat, row.clng, row.h3_wkt) == (None, None, None, None)


def test_foreign_ids_have_no_centre(spark):
    df = spark.createDataFrame([("8928308280fffff",), ("hx9_a_b",), ("",)], "h3_index string")
    got = GRID.add_outline(GRID.add_centre(df, "h3_index", "lat", "lng"), "h3_index")
    assert all(r.lat is None and r.h3_wkt is None for r in got.collect())


def test_outline_is_a_closed_counter_clockwise_hexagon(spark):
    cells = GRID.assign(_points(spark, [(21.5486, 105.8441), (8.6, 104.7)]), "lat", "lng")
    for row in GRID.add_outline(cells, "h3_index").collect():
        body = re.fullmatch(r"POLYGON\(\((.*)\)\)", row.h3_wkt).group(1)
        ring = [tuple(map(float, p.split(" "))) for p in body.split(", ")]
        assert len(ring) == 7 and ring[0] == ring[-1]
        flat = [_plane(lat, lng) for lng, lat in ring]
        area = sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(flat, flat[1:])) / 2.0
        assert area == pytest.approx(1.5 * math.sqrt(3.0) * GRID.edge_km**2, rel=1e-3)
        for a, b in zip(flat, flat[1:]):
            assert math.dist(a, b) == pytest.approx(GRID.edge_km, rel=1e-3)


def _distances(spark, rows):
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    ends = [F.col(x) for x in "abcd"]
    return df.select(haversine_km(*ends).alias("h"), law_of_cosines_km(*ends).alias("s")).collect()


@settings(max_examples=8, deadline=None)
@given(pairs=st.lists(st.tuples(*[st.floats(-90, 90), st.floats(-180, 180)] * 2), min_size=1, max_size=40))
def test_distances_are_symmetric_and_never_nan(spark, pairs):
    there = _distances(spark, pairs)
    back = _distances(spark, [(c, d, a, b) for a, b, c, d in pairs])
    for t, b in zip(there, back):
        assert t.h >= 0.0 and t.h == pytest.approx(b.h, abs=1e-6)
        assert t.s >= 0.0 and not math.isnan(t.s)
        assert t.h == pytest.approx(t.s, abs=1e-3)


def test_coincident_points_are_zero_apart(spark):
    places = [(8.5 + i * 0.0149, 102.1 + i * 0.0073) for i in range(1000)]
    for row in _distances(spark, [(a, b, a, b) for a, b in places]):
        assert row.h == 0.0
        assert row.s == pytest.approx(0.0, abs=1e-3)


def test_known_distances(spark):
    quarter = 6371.0 * math.pi / 2.0
    rows = [(0.0, 0.0, 0.0, 90.0), (90.0, 0.0, 0.0, 17.0), (0.0, 0.0, 0.0, 180.0)]
    got = _distances(spark, rows)
    for row, expected in zip(got, [quarter, quarter, 2.0 * quarter]):
        assert row.h == pytest.approx(expected) and row.s == pytest.approx(expected)


def test_unknown_ends_give_no_distance(spark):
    got = _distances(spark, [(None, 1.0, 2.0, 3.0), (1.0, 2.0, 3.0, None)])
    assert all(r.h is None and r.s is None for r in got)


def test_positions_off_the_globe_and_around_it(spark):
    nan, inf = math.nan, math.inf
    off = [(nan, 1.0), (1.0, nan), (inf, 1.0), (1.0, -inf), (90.5, 1.0), (-91.0, 1.0)]
    cells = GRID.assign(_points(spark, off), "lat", "lng", centre=("clat", "clng")).collect()
    assert all((r.h3_index, r.clat, r.clng) == (None, None, None) for r in cells)
    same = [(21.5, 105.8), (21.5, 465.8), (21.5, -254.2)]
    assert len({r.h3_index for r in GRID.assign(_points(spark, same), "lat", "lng").collect()}) == 1
    poles = GRID.assign(_points(spark, [(90.0, 0.0), (-90.0, 180.0), (0.0, -180.0), (0.0, 180.0)]), "lat", "lng").collect()
    assert all(r.h3_index for r in poles) and poles[2].h3_index == poles[3].h3_index
