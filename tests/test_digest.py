import pytest
from helpers import land, measurement
from pyspark.sql import functions as F

from celltide import schemas
from celltide.operators import digest, quality
from celltide.plans.medallion import Lakehouse, Settings, run_range
from celltide.schemas import Batch

SCHEMA = "date string, hour string, a string, b string, x double"
ROWS = [("d", "01", f"a{i % 7}", None if i % 5 == 0 else f"b{i % 3}", i / 4) for i in range(40)]
ROWS += [("d", "02", None, "b", None), ("d", "02", "b", None, None)]
COLUMNS = ["a", "b", "x"]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def equal(spark, whole, *parts):
    found = digest.reconciled(frame(spark, whole), [frame(spark, p) for p in parts], COLUMNS)
    return {r.hour: (r.rows_before, r.rows_after, r.equal) for r in found.collect()}


def test_order_files_and_the_split_do_not_matter(spark):
    assert equal(spark, ROWS, ROWS[::-1]) == {"01": (40, 40, True), "02": (2, 2, True)}
    assert equal(spark, ROWS, ROWS[::2], ROWS[1::2], []) == {"01": (40, 40, True), "02": (2, 2, True)}
    spread = frame(spark, ROWS).repartition(7)
    assert {r.equal for r in digest.reconciled(spread, [frame(spark, ROWS).coalesce(1)], COLUMNS).collect()} == {True}


@pytest.mark.parametrize(
    "change",
    [
        lambda rows: rows[1:],
        lambda rows: [*rows, rows[3]],
        lambda rows: [*rows[1:], rows[3]],  # one lost, another twice: the same number
        lambda rows: [(*rows[0][:3], "other", rows[0][4]), *rows[1:]],
        lambda rows: [(*rows[0][:2], rows[1][2], *rows[0][3:]), (*rows[1][:2], rows[0][2], *rows[1][3:]), *rows[2:]],  # values swapped
        lambda rows: [(*rows[0][:3], rows[0][2], None), *rows[1:]],
    ],
)
def test_every_change_shows(spark, change):
    found = equal(spark, ROWS, change(ROWS))
    assert found["01"][2] is False and found["02"][2] is True


def test_nulls_are_told_apart_by_their_column(spark):
    swapped = [("d", "02", "b", None, None), ("d", "02", "b", None, None)]
    assert equal(spark, ROWS[40:], swapped)["02"] == (2, 2, False)


def test_hours_of_one_side_only(spark):
    assert equal(spark, ROWS, ROWS[:40]) == {"01": (40, 40, True), "02": (2, 0, False)}
    assert equal(spark, ROWS[:40], ROWS) == {"01": (40, 40, True), "02": (0, 2, False)}
    assert equal(spark, [], []) == {}


def test_digests_add_up(spark):
    whole = digest.digests(frame(spark, ROWS[:40]), COLUMNS, ["date"])
    halves = [digest.digests(frame(spark, ROWS[i:40:2]), COLUMNS, ["date"]).withColumnRenamed("digest", f"d{i}") for i in (0, 1)]
    sums = halves[0].join(halves[1], "date").select("date", digest.added(F.col("d0"), F.col("d1")).alias("sum"))
    assert whole.join(sums, "date").where("digest = sum").count() == 1


def test_only_counts_are_shuffled(spark):
    plan = digest.reconciled(frame(spark, ROWS), [frame(spark, ROWS)], COLUMNS)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "partial_sum" in plan


def test_a_run_is_reconciled(spark, tmp_path):
    hours = [Batch("2026-05-05", h) for h in ("07", "08", "09")]
    for b in hours:
        bad = {"lat": 0.0, "lng": 0.0, "p_cell_rsrp": -150, "p_cell_rsrq": 0.0}
        rows = [measurement(hour=b.hour, cell_id=c) for c in ("a", "b", "b", None)] + [measurement(hour=b.hour, p_cell_rsrp=None)]
        land(str(tmp_path / "landing"), b, [measurement(hour="09", date_hour="x", **bad)] * 3 if b.hour == "09" else rows)
    cells = spark.createDataFrame([("a", 21.5, 105.8)], schemas.CELL_INFO)
    for policy, before in (("quarantine", 5), ("drop", 4)):
        lake = Lakehouse(spark, Settings(str(tmp_path / "landing"), str(tmp_path / policy), null_policy=policy))
        run_range(lake, hours, cells)
        found = {(r.hour, r.step): (r.rows_before, r.rows_after, r.equal) for r in lake.reconcile(hours).collect()}
        assert found == {
            ("07", "split"): (before, before, True), ("08", "split"): (before, before, True), ("09", "split"): (3, 3, True),
            ("07", "enrich"): (4, 4, True), ("08", "enrich"): (4, 4, True),
        }
        some = lake.enriched.scan([hours[0]]).where("cell_id = 'a'").unionByName(lake.enriched.scan([hours[0]]).where("cell_id = 'b'"))
        lake.enriched.replace(lake.workspace.stage(some, "some"), [hours[0]])
        found = {(r.hour, r.step): r.equal for r in lake.reconcile(hours).collect()}
        assert [k for k, same in found.items() if not same] == [("07", "enrich")]


def test_repeats_are_counted_exactly(spark):
    rows = [*ROWS, *ROWS[:3], ROWS[0], ("d", "02", None, "b", None)]
    found = {r.hour: (r.total_rows, r.repeated_rows) for r in quality.repeats(frame(spark, rows)).collect()}
    distinct = len(set(rows[:40] + rows[42:46]))
    assert found == {"01": (44, 44 - distinct), "02": (3, 1)}
    assert quality.repeats(frame(spark, [])).isEmpty()


def test_a_row_repeated_a_million_times_does_not_meet_in_a_task(spark):
    rows = spark.range(1_000_000).select(F.lit("d").alias("date"), F.lit("01").alias("hour"), F.lit("same").alias("a"))
    counted = quality.repeats(rows.repartition(8))
    assert counted.collect()[0].repeated_rows == 999_999
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan  # a row per task and hash is what is sent


def test_repeats_have_a_column_of_their_own_in_the_report(spark, tmp_path):
    nine = Batch("2026-05-05", "09")
    land(str(tmp_path / "landing"), nine, [measurement()] * 3 + [measurement(cell_id="b")])
    cells = spark.createDataFrame([("a", 21.5, 105.8)], schemas.CELL_INFO)
    lake = Lakehouse(spark, Settings(str(tmp_path / "landing"), str(tmp_path / "lake"), count_repeats=True))
    run_range(lake, [nine], cells)
    report = lake.reports.scan().first()
    assert (report.repeated_count, report.duplicate_count, report.total_raw_records) == (2, 0, 4)
