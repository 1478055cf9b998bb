import os

import pytest
from helpers import land, measurement

from celltide import __main__ as cli
from celltide import schemas
from celltide.plans import medallion
from celltide.plans.medallion import Lakehouse, Settings, run_changed
from celltide.schemas import Batch
from celltide.sources import landing
from celltide.sources.landing import LandingFile

EIGHT, NINE, TEN = (Batch("2026-05-05", h) for h in ("08", "09", "10"))
HOURS = [EIGHT, NINE, TEN]


@pytest.fixture
def cells(spark):
    return spark.createDataFrame([("a", 21.5, 105.8)], schemas.CELL_INFO)


@pytest.fixture
def lake(spark, tmp_path):
    for b in HOURS[:2]:
        land(str(tmp_path / "landing"), b, [measurement(hour=b.hour), measurement(hour=b.hour, cell_id="b")])
    return Lakehouse(spark, Settings(str(tmp_path / "landing"), str(tmp_path / "lake")))


@pytest.fixture
def read_hours(monkeypatch):
    """The hours whose landing rows have been read."""
    seen = []
    before = landing.read_layout

    def read(spark, files, *args, **options):
        seen.extend(b.hour for b in files.batches())
        return before(spark, files, *args, **options)

    monkeypatch.setattr(medallion.landing, "read_layout", read)
    return seen


def path_of(tmp_path, batch):
    return tmp_path / "landing" / f"mdt_records_{batch.key}.csv"


def test_an_unchanged_hour_is_not_read(lake, cells, tmp_path, read_hours):
    first = run_changed(lake, HOURS, cells)
    assert (first.passed, first.missing, first.unchanged) == ([EIGHT, NINE], [TEN], [])
    read_hours.clear()
    again = run_changed(lake, HOURS, cells)
    assert (again.passed, again.missing, again.unchanged) == ([], [TEN], [EIGHT, NINE])
    assert read_hours == []

    land(str(tmp_path / "landing"), NINE, [measurement(cell_id="c")])
    land(str(tmp_path / "landing"), TEN, [measurement(hour="10")])
    later = run_changed(lake, HOURS, cells)
    assert (later.passed, later.unchanged) == ([NINE, TEN], [EIGHT])
    assert sorted(read_hours) == ["09", "10"]
    assert {(r.hour, r.cell_id) for r in lake.gold.scan().collect()} == {("08", "a"), ("08", "b"), ("09", "c"), ("10", "a")}


def test_a_file_that_was_only_touched_is_read_once_and_not_processed(lake, cells, tmp_path, read_hours):
    run_changed(lake, HOURS, cells)
    read_hours.clear()
    before = lake.gold.file_sizes(HOURS)
    os.utime(path_of(tmp_path, NINE), (1, 1))
    assert run_changed(lake, HOURS, cells).unchanged == [EIGHT, NINE]
    assert read_hours == ["09"]
    assert lake.gold.file_sizes(HOURS) == before
    read_hours.clear()
    assert run_changed(lake, HOURS, cells).unchanged == [EIGHT, NINE]
    assert read_hours == []


def test_other_rows_of_the_same_length_are_processed(lake, cells, tmp_path):
    run_changed(lake, HOURS, cells)
    path = path_of(tmp_path, NINE)
    content = path.read_bytes()
    assert content.count(b",b") == 1
    path.write_bytes(content.replace(b",b", b",z"))
    os.utime(path, (5, 5))
    outcome = run_changed(lake, HOURS, cells)
    assert (outcome.passed, outcome.unchanged) == ([NINE], [EIGHT])
    assert {r.cell_id for r in lake.gold.scan([NINE]).collect()} == {"a", "z"}


def test_an_hour_that_did_not_get_through_is_taken_again(lake, cells, tmp_path, monkeypatch):
    def fails(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken, pytest.raises(RuntimeError, match="lost"):
        broken.setattr(medallion, "run_stored", fails)
        run_changed(lake, HOURS, cells)
    assert run_changed(lake, HOURS, cells).passed == [EIGHT, NINE]


def test_an_unmappable_delivery_is_tried_again(lake, cells, tmp_path):
    run_changed(lake, HOURS, cells)
    good = path_of(tmp_path, NINE).read_bytes()
    path_of(tmp_path, NINE).write_text("a,b\n1,2\n")
    for _ in range(2):
        assert run_changed(lake, HOURS, cells).unmappable == [NINE]
    path_of(tmp_path, NINE).write_bytes(good)
    os.utime(path_of(tmp_path, NINE), (7, 7))
    assert run_changed(lake, HOURS, cells).unchanged == [EIGHT, NINE]  # the rows of before


def test_files_of_an_hour_are_compared_by_name(lake):
    def files(*names):
        return [LandingFile(NINE, f"/x/{n}", length, time) for n, length, time in names]

    ledger = lake.ledger
    assert ledger.compare([]).new == []
    assert ledger.compare(files(("a", 1, 1))).new == [NINE]
    ledger.record(files(("a", 1, 1), ("b", 2, 1)), [NINE])
    assert ledger.compare(files(("b", 2, 1), ("a", 1, 1))).unchanged == [NINE]
    assert ledger.compare(files(("a", 1, 2), ("b", 2, 1))).touched == [NINE]
    assert ledger.compare(files(("a", 1, 1))).restated == [NINE]
    assert ledger.compare(files(("a", 1, 1), ("b", 2, 1), ("c", 0, 1))).restated == [NINE]


def test_the_command_runs_changed_hours(lake, spark, tmp_path, read_hours):
    spark.createDataFrame([("a", 21.5, 105.8)], schemas.CELL_INFO).write.parquet(str(tmp_path / "cells"))
    argv = ["changed", "--landing", str(tmp_path / "landing"), "--lake", str(tmp_path / "lake"), "--date", "2026-05-05",
            "--hour", "08", "--until", "2026-05-05-09", "--cells", str(tmp_path / "cells")]
    for expected in (["08", "09"], []):
        read_hours.clear()
        assert cli.run(spark, cli.parser().parse_args(argv)) == 0
        assert sorted(read_hours) == expected
