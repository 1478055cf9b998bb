import pytest
from helpers import as_set, land, measurement

from celltide import schemas
from celltide.operators.quality import QualityGateError
from celltide.plans.medallion import Lakehouse, Settings, run_batch, run_range
from celltide.schemas import Batch
from celltide.streaming.catchup import catch_up

DAY = "2026-05-05"
HOURS = [Batch(DAY, h) for h in ("07", "08", "09", "10")]


def _hour(batch):
    """07 good, 08 with defects, 09 blocked, 10 without rows."""
    h = batch.hour
    good = [
        measurement(hour=h, cell_id=c, lat=21.5 + i / 400, p_cell_rsrp=-80 - i)
        for i, c in enumerate(["a", "a", "b", "b", "b", None])
    ]
    if h == "08":
        return good + [measurement(hour=h, lat=0.0), measurement(hour=h, p_cell_rsrp=None)]
    if h == "09":
        bad = measurement(hour=h, lat=0.0, lng=0.0, p_cell_rsrp=-150, p_cell_rsrq=0.0)
        return good + [bad, measurement(hour=h, date_hour="2026-05-05-08")]
    return [] if h == "10" else good


@pytest.fixture
def cell_info(spark):
    return spark.createDataFrame([("a", 21.5, 105.8)], schemas.CELL_INFO)


@pytest.fixture
def make(spark, tmp_path):
    for b in HOURS:
        land(str(tmp_path / "landing"), b, _hour(b))

    def lake(name, **settings):
        return Lakehouse(
            spark, Settings(str(tmp_path / "landing"), str(tmp_path / name), **settings)
        )

    return lake


def _tables(lake):
    clocks = {"processed_at", "created_at"}
    tables = [lake.bronze, lake.checked, lake.reports, lake.enriched, lake.gold]
    return [
        as_set(t.scan(), *[c for c in t.schema.names if c not in clocks]) for t in tables
    ]


def test_a_range_equals_its_hours_and_a_rerun_changes_nothing(make, cell_info):
    many, single = make("many"), make("single")
    outcome = run_range(many, HOURS, cell_info)
    assert [b.hour for b in outcome.passed] == ["07", "08"]
    assert [b.hour for b in outcome.blocked] == ["09"]
    assert [b.hour for b in outcome.empty] == ["10"]
    tables = _tables(many)

    for b in HOURS:
        if b.hour == "09":
            with pytest.raises(QualityGateError):
                run_batch(single, b, cell_info)
        else:
            run_batch(single, b, cell_info)
    assert _tables(single) == tables

    run_range(many, HOURS, cell_info)
    assert _tables(many) == tables

    # evidence of the blocked hour is kept, nothing of it goes further
    assert {r.hour for r in many.reports.scan().collect()} == {"07", "08", "09"}
    assert {r.hour for r in many.quarantine().collect()} == {"08", "09"}
    assert {r.hour for r in many.gold.scan().collect()} == {"07", "08"}
    assert many.clean().count() == 18
    assert many.gold.scan().agg({"user_density_count": "sum"}).first()[0] == 12


def test_a_corrected_hour_replaces_the_old_one(make, cell_info, tmp_path):
    lake = make("lake")
    run_batch(lake, HOURS[1], cell_info)
    assert lake.quarantine().count() == 2
    land(str(tmp_path / "landing"), HOURS[1], [measurement(hour="08")])
    run_batch(lake, HOURS[1], cell_info)
    assert lake.quarantine().isEmpty()
    assert lake.gold.scan().first().user_density_count == 1
    land(str(tmp_path / "landing"), HOURS[1], [])
    assert run_batch(lake, HOURS[1], cell_info).empty == [HOURS[1]]
    for table in (lake.bronze, lake.checked, lake.reports, lake.enriched, lake.gold):
        assert table.scan().isEmpty()


def test_an_hour_that_is_blocked_later_leaves_gold(make, cell_info, tmp_path):
    lake = make("lake")
    run_range(lake, HOURS[:2], cell_info)
    bad = _hour(HOURS[2])[-2:]
    land(str(tmp_path / "landing"), HOURS[0], [{**r, "hour": "07"} for r in bad])
    assert run_range(lake, HOURS[:2], cell_info).blocked == [HOURS[0]]
    for table in (lake.enriched, lake.gold):
        assert {r.hour for r in table.scan().collect()} == {"08"}
    assert {r.hour for r in lake.checked.scan().collect()} == {"07", "08"}


def test_the_gate_holds_in_every_stage(make, cell_info):
    whole, staged = make("whole"), make("staged")
    run_range(whole, HOURS, cell_info)
    staged.ingest(HOURS)
    assert staged.blocked(HOURS) == []
    staged.check(HOURS)
    assert staged.blocked(HOURS) == [HOURS[2]]
    staged.enrich(HOURS, cell_info)
    staged.aggregate(HOURS)
    assert _tables(staged) == _tables(whole)


def test_an_hour_without_clean_rows_does_not_pass_unnoticed(make, cell_info, tmp_path, caplog):
    land(str(tmp_path / "landing"), HOURS[0], [measurement(hour="07", p_cell_rsrp=v) for v in (-97.5, "x")])
    lake = make("lake")
    land(str(tmp_path / "landing"), HOURS[0], [measurement(hour="07", p_cell_rsrp=v) for v in (-97.5, "x")])
    with caplog.at_level("ERROR"):
        run_batch(lake, HOURS[0], cell_info)
    assert "without a single clean row" in caplog.text
    report = lake.reports.scan().first()
    assert (report.clean_count, report.undecided_count, report.unreadable_count) == (0, 2, 2)
    land(str(tmp_path / "landing"), HOURS[0], [measurement(hour="07", p_cell_rsrp="-97.0")] * 3)
    run_batch(lake, HOURS[0], cell_info)
    report = lake.reports.scan().first()
    assert (report.clean_count, report.unreadable_count, report.gx_success_rate) == (3, 0, 100.0)


def test_ingesting_again_reads_the_landing_files_once(spark, make):
    lake = make("lake")
    for group in ("first", "again"):
        spark.sparkContext.setJobGroup(group, group)
        try:
            lake.ingest(HOURS)
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
        assert len(jobs) == 1  # the write itself
    assert {r.hour for r in lake.bronze.scan().collect()} == {"07", "08", "09"}


def test_scratch_is_dropped_with_the_stage(make, cell_info):
    import os

    lake = make("lake")
    run_range(lake, HOURS, cell_info)
    assert os.listdir(lake.workspace.root.removeprefix("file:")) == []


def test_without_broadcasts_the_tables_are_the_same(spark, make, cell_info):
    expected, large = make("small"), make("large")
    run_range(expected, HOURS, cell_info)
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        run_range(large, HOURS, cell_info)
    finally:
        spark.conf.set(name, before)
    assert _tables(large) == _tables(expected)


def test_a_missing_file_holds_up_its_hour_only(make, cell_info):
    lake = make("lake")
    absent = Batch(DAY, "12")
    outcome = run_range(lake, [HOURS[0], absent], cell_info)
    assert (outcome.passed, outcome.missing) == ([HOURS[0]], [absent])
    assert {r.hour for r in lake.gold.scan().collect()} == {"07"}
    assert run_range(lake, [absent], cell_info).missing == [absent]
    with pytest.raises(FileNotFoundError):
        run_batch(lake, absent, cell_info)


def test_the_map_and_audit_of_a_day(make, cell_info):
    lake = make("lake")
    assert lake.map_day(DAY) is None and lake.audit_day(DAY) is None
    run_range(lake, HOURS, cell_info)
    stamps = [r.record_time.hour for r in lake.map_day(DAY).collect()]
    assert stamps == sorted(stamps) and set(stamps) == {7, 8}
    assert [r.hour for r in lake.audit_day(DAY).collect()] == ["07", "08", "09"]
    assert lake.map_day("2026-05-06").isEmpty()


def test_a_stage_without_input_does_nothing(make):
    lake = make("lake")
    assert lake.check(HOURS).empty == HOURS
    lake.enrich(HOURS, None)
    lake.aggregate(HOURS)
    with pytest.raises(ValueError):
        lake.publish(HOURS)


def test_the_null_policy_is_a_setting(make, cell_info):
    lake = make("lake", null_policy="drop")
    run_batch(lake, HOURS[1], cell_info)
    assert lake.quarantine().count() == 1
    assert lake.reports.scan().first().dirty_count == 1


def test_new_files_are_caught_up_once(make, cell_info, tmp_path):
    lake, expected = make("stream"), make("range")
    run_range(expected, HOURS, cell_info)
    checkpoint = str(tmp_path / "checkpoint")
    outcomes = []
    catch_up(lake, cell_info, checkpoint, outcomes.append).awaitTermination(120)
    assert _tables(lake) == _tables(expected)
    assert [o.blocked for o in outcomes] == [[HOURS[2]]]

    eleven = Batch(DAY, "11")
    land(str(tmp_path / "landing"), eleven, [measurement(hour="11")])
    query = catch_up(lake, cell_info, checkpoint)
    query.awaitTermination(120)
    assert query.exception() is None
    assert sum(p.numInputRows for p in query.recentProgress) <= 2  # the new file alone
    assert {r.hour for r in lake.gold.scan().collect()} == {"07", "08", "11"}
