import logging

import pytest
from helpers import GOOD, NINE, as_set, frame, land, measurement

from celltide import schemas
from celltide.plans.medallion import Lakehouse, Settings, run_batch, run_range
from celltide.schemas import Batch
from celltide.sources import landing

NAMES = [f.name for f in schemas.LANDING]
EIGHT, TEN, ELEVEN = (Batch("2026-05-05", h) for h in ("08", "10", "11"))


def write(folder, batch, header, *lines):
    folder.mkdir(exist_ok=True)
    path = folder / f"mdt_records_{batch.key}.csv"
    path.write_text("\n".join([header, *lines]) + ("\n" if header else ""), encoding="utf-8")
    return str(path)


def line(names, **changed):
    row = measurement(**changed)
    return ",".join("x" if n not in row else "" if row[n] is None else str(row[n]) for n in names)


@pytest.fixture
def folder(tmp_path):
    return tmp_path / "landing"


def read(spark, folder, *batches, **options):
    return landing.read_landing(spark, str(folder), list(batches), **options)


def test_columns_are_mapped_by_name(spark, folder):
    moved = NAMES[::-1]
    write(folder, EIGHT, ",".join(NAMES), line(NAMES, hour="08"))
    write(folder, NINE, ",".join(moved), line(moved))
    write(folder, TEN, ",".join(f" {n.title()}" for n in NAMES), line(NAMES, hour="10"))
    rows = read(spark, folder, EIGHT, NINE, TEN)
    assert rows.schema.names == schemas.RAW.names
    assert as_set(rows) == as_set(frame(spark, [measurement(hour=h) for h in ("08", "09", "10")]))


def test_missing_columns_are_null_and_others_left_out(spark, folder, caplog):
    names = ["vendor", *[n for n in NAMES if n not in ("cell_id", "province_name")], "", "note"]
    write(folder, NINE, ",".join(names), line(names))
    with caplog.at_level(logging.WARNING):
        row = read(spark, folder, NINE).first()
    assert "'vendor', '', 'note'" in caplog.text
    assert row.asDict() == {**GOOD, "cell_id": None, "province_name": None}
    extra = read(spark, folder, NINE, extra=True).first().extra
    assert extra == {"vendor": "x", "": "x", "note": "x"}


def test_repeated_and_clashing_names(spark, folder):
    names = [*NAMES, "note", "note", "date", "hour", "unreadable", "_metadata", "a.b", "c`d"]
    write(folder, NINE, ",".join(names), line(names))
    write(folder, TEN, ",".join([*NAMES, "a.b"]), line([*NAMES, "a.b"], hour="10"))
    rows = read(spark, folder, NINE, TEN, extra=True).orderBy("hour").collect()
    assert [(r.date, r.hour, r.unreadable) for r in rows] == [("2026-05-05", "09", None), ("2026-05-05", "10", None)]
    assert sorted(rows[0].extra) == sorted({*names} - {*NAMES})
    assert rows[1].extra == {"a.b": "x"}


def test_rows_that_do_not_fit_their_header_are_told(spark, folder):
    names = ["vendor", *NAMES]
    write(folder, NINE, ",".join(names), line(names), "x,1", line(names) + ",more", line(names, p_cell_rsrp="-97.5"))
    rows = read(spark, folder, NINE).collect()
    assert [r.unreadable is None for r in rows] == [True, False, False, False]
    assert rows[3].unreadable == "p_cell_rsrp=-97.5"


def test_marks_quotes_and_empty_files(spark, folder):
    quoted = ",".join(f'"{n}"' for n in NAMES)
    write(folder, NINE, "﻿" + quoted, line(NAMES))
    write(folder, TEN, "")
    assert read(spark, folder, NINE, TEN).count() == 1
    assert read(spark, folder, TEN).schema.names == schemas.RAW.names
    assert read(spark, folder, TEN).count() == 0


@pytest.mark.parametrize(
    "header, why",
    [
        ([n for n in NAMES if n != "lat"], "no column lat"),
        ([*NAMES, "LAT"], "column lat more than once"),
        (["a", "b"], "no column p_cell_rsrp, p_cell_rsrq, lat, lng, date_hour"),
    ],
)
def test_headers_that_cannot_be_mapped(spark, folder, header, why):
    assert landing.unmappable(tuple(header)) == why
    write(folder, NINE, ",".join(header), line(header))
    with pytest.raises(landing.UnmappableHeaderError, match=why):
        read(spark, folder, NINE)


def test_a_line_without_an_end_is_no_header(spark, folder):
    write(folder, NINE, "x" * 300_000)
    assert len(landing.read_headers(spark, [str(folder / f"mdt_records_{NINE.key}.csv")])[0][0]) == landing.HEADER_BYTES
    with pytest.raises(landing.UnmappableHeaderError):
        read(spark, folder, NINE)


def test_an_hour_may_be_a_folder_of_files_of_several_headers(spark, folder):
    hour = folder / f"mdt_records_{NINE.key}.csv"
    hour.mkdir(parents=True)
    (hour / "part-0.csv").write_text("\n".join([",".join(NAMES), line(NAMES)]))
    (hour / "part-1.csv").write_text("\n".join([",".join(NAMES[::-1]), line(NAMES[::-1], cell_id="b")]))
    (hour / "_SUCCESS").write_text("")
    (hour / ".part-0.csv.crc").write_text("odd")
    assert {r.cell_id for r in read(spark, folder, NINE).collect()} == {"a", "b"}
    (hour / "part-2.csv").write_text("nothing,of,use\n1,2,3")
    with pytest.raises(landing.UnmappableHeaderError):
        read(spark, folder, NINE)


def test_files_of_one_header_share_a_scan(spark, folder):
    for b in (EIGHT, NINE, TEN):
        write(folder, b, ",".join(NAMES), line(NAMES, hour=b.hour))
    write(folder, ELEVEN, ",".join(NAMES[::-1]), line(NAMES[::-1], hour="11"))
    plan = read(spark, folder, EIGHT, NINE, TEN, ELEVEN)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 2


def test_an_unmappable_file_holds_up_its_hour_only(spark, folder, tmp_path):
    lake = Lakehouse(spark, Settings(str(folder), str(tmp_path / "lake")))
    cells = spark.createDataFrame([("a", 21.5, 105.8)], schemas.CELL_INFO)
    land(str(folder), NINE, [measurement()])
    run_batch(lake, NINE, cells)
    write(folder, NINE, "a,b", "1,2")
    write(folder, TEN, ",".join(NAMES[::-1]), line(NAMES[::-1], hour="10"))
    outcome = run_range(lake, [NINE, TEN, ELEVEN], cells)
    assert (outcome.passed, outcome.unmappable, outcome.missing) == ([TEN], [NINE], [ELEVEN])
    assert {r.hour for r in lake.gold.scan().collect()} == {"09", "10"}  # the earlier delivery stays
    with pytest.raises(landing.UnmappableHeaderError):
        run_batch(lake, NINE, cells)
