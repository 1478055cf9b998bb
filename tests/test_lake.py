import os

import pytest
from helpers import as_set, frame, land, measurement
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from celltide import schemas
from celltide.operators import quality
from celltide.schemas import Batch
from celltide.sources import landing
from celltide.sources.lake import LakeTable
from celltide.sources.workspace import Workspace, shared_folder

DAY = "2026-05-05"
EIGHT, NINE, TEN = (Batch(DAY, h) for h in ("08", "09", "10"))


@pytest.fixture
def table(spark, tmp_path):
    return LakeTable(spark, str(tmp_path / "t"), schemas.RAW)


def _hours(df):
    return sorted(r.hour for r in df.select("hour").collect())


def test_replace_touches_only_its_hours(spark, table):
    table.replace(frame(spark, [measurement(hour=h) for h in ("08", "09", "09")]), [EIGHT, NINE])
    table.replace(frame(spark, [measurement(hour="09", cell_id="new")]), [NINE])
    assert as_set(table.scan(), "hour", "cell_id") == [("08", "a"), ("09", "new")]


def test_replacing_twice_is_replacing_once(spark, table):
    rows = frame(spark, [measurement(hour="08"), measurement(hour="09")])
    table.replace(rows, [EIGHT, NINE])
    once = as_set(table.scan())
    table.replace(rows, [EIGHT, NINE])
    assert as_set(table.scan()) == once


def test_an_empty_hour_is_emptied(spark, table):
    table.replace(frame(spark, [measurement(hour=h) for h in ("08", "09")]), [EIGHT, NINE])
    late = frame(spark, [measurement(hour="08", cell_id="b")])
    table.replace(late, [EIGHT, NINE])
    assert as_set(table.scan(), "hour", "cell_id") == [("08", "b")]
    table.replace(late.limit(0), [EIGHT])
    assert table.scan().isEmpty()


@pytest.mark.parametrize("stray", [{"hour": "08"}, {"hour": None}, {"date": None}])
def test_a_row_of_another_hour_is_an_error(spark, table, stray):
    table.replace(frame(spark, [measurement(hour="08")]), [EIGHT])
    row = {**measurement(hour="09"), **stray}
    with pytest.raises(Exception, match="row outside the batches"):
        table.replace(frame(spark, [measurement(hour="09"), row]), [NINE])
    assert _hours(table.scan()) == ["08"]


def test_removed_hours_are_empty(spark, table):
    table.remove([NINE])
    table.replace(frame(spark, [measurement(hour=h) for h in ("08", "09")]), [EIGHT, NINE])
    table.remove([NINE, TEN])
    assert _hours(table.scan()) == ["08"]


def test_a_run_of_one_hour_lists_that_hour_only(spark, table, monkeypatch):
    table.replace(frame(spark, [measurement(hour=f"{h:02d}") for h in range(24)]), Batch.day(DAY))
    assert table.exists()
    one = table.scan([NINE])
    assert len({f.rsplit("/", 1)[0] for f in one.inputFiles()}) == 1
    absent = table.scan([Batch("2027-01-01", "00")])  # without looking at the table's files
    assert absent.isEmpty() and not absent.inputFiles() and sorted(absent.columns) == sorted(one.columns)


def test_leading_partitions_are_emptied_too(spark, tmp_path):
    schema = schemas.table_schema(schemas.RAW, "verdict string")
    table = LakeTable(spark, str(tmp_path / "t"), schema, ("verdict",))

    def marked(*verdicts):
        return frame(spark, [{**measurement(), "verdict": v} for v in verdicts], schema)

    table.replace(marked("clean", "dirty"), [NINE])
    table.replace(marked("clean"), [NINE])
    assert as_set(table.scan(), "verdict") == [("clean",)]


def test_rebalanced_hours_are_whole(spark, table):
    rows = frame(spark, [measurement(hour=f"{i % 24:02d}") for i in range(240)]).repartition(8)
    table.replace(rows, Batch.day(DAY), rebalance=True)
    assert table.scan().count() == 240
    files = [f for _, _, names in os.walk(table.root) for f in names if f.endswith(".parquet")]
    assert len(files) == 24


def test_hour_stays_text_and_partitions_are_pruned(spark, table):
    table.replace(frame(spark, [measurement(hour=h) for h in ("08", "09")]), [EIGHT, NINE])
    assert all("hour=09" in f for f in table.scan([NINE, TEN]).inputFiles())
    assert table.scan([TEN]).isEmpty() and table.scan([TEN]).schema == table.scan().schema
    one = table.scan([NINE]).filter("lat > 0").select("lat", "hour")
    assert one.first().hour == "09"
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    assert "GreaterThan(lat,0.0)" in plan and "ReadSchema: struct<lat:double>" in plan


def test_the_row_predicate_reaches_the_scan(spark, table):
    table.replace(frame(spark, [measurement(hour="09")]), [NINE])
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    plan = quality.accepted(table.scan([NINE]))._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    for pushed in ("GreaterThanOrEqual(lat,8.5)", "LessThanOrEqual(p_cell_rsrp,-44)"):
        assert pushed in plan


def test_only_a_missing_table_is_tolerated(spark, table, monkeypatch):
    assert table.scan_if_present([NINE]) is None
    with pytest.raises(AnalysisException):
        table.scan()

    def broken(self, batches=None):
        return spark.sql("SELECT no_such_column")

    monkeypatch.setattr(LakeTable, "scan", broken)
    monkeypatch.setattr(LakeTable, "exists", lambda self: True)
    with pytest.raises(AnalysisException):
        table.scan_if_present()


def test_added_columns_are_found(spark, table, tmp_path):
    table.replace(frame(spark, [measurement(hour="08")]), [EIGHT])
    wider = schemas.table_schema(schemas.RAW, "extra bigint")
    table.replace(frame(spark, [{**measurement(), "extra": 7}], wider), [NINE])
    assert as_set(table.scan(), "hour", "extra") == [("08", None), ("09", 7)]
    assert as_set(table.scan([EIGHT]), "hour", "extra") == [("08", None)]
    again = LakeTable(spark, table.root, schemas.RAW)
    assert "extra" in again.scan().columns


def test_a_changed_type_is_refused_before_anything_is_written(spark, table):
    table.replace(frame(spark, [measurement(hour="08")]), [EIGHT])
    texts = frame(spark, [measurement(hour="08")]).withColumn("lat", F.col("lat").cast("string"))
    with pytest.raises(ValueError, match="lat of .* is double and would become string"):
        table.replace(texts, [EIGHT])
    wider = schemas.table_schema(schemas.RAW, "extra bigint")
    table.replace(frame(spark, [{**measurement(hour="09"), "extra": 7}], wider), [NINE])
    with pytest.raises(ValueError, match="extra"):
        table.replace(frame(spark, [measurement(hour="09")]).withColumn("extra", F.lit("x")), [NINE])
    assert _hours(table.scan()) == ["08", "09"]


def test_formats_are_checked(spark):
    with pytest.raises(ValueError):
        LakeTable(spark, "/tmp/x", schemas.RAW, fmt="orc")
    with pytest.raises(ValueError, match="Delta"):
        LakeTable(spark, "/tmp/x", schemas.RAW, fmt="delta")


def test_landing_files_of_many_hours(spark, tmp_path):
    folder = str(tmp_path / "landing")
    for batch in (NINE, TEN):
        land(folder, batch, [measurement(hour=batch.hour), measurement(hour=batch.hour, lat=None)])
    both = landing.read_landing(spark, folder, [NINE, TEN])
    assert both.schema.names == schemas.RAW.names
    assert [f.dataType for f in both.schema] == [f.dataType for f in schemas.RAW]
    assert _hours(both) == ["09", "09", "10", "10"]
    assert as_set(landing.read_landing(spark, folder, [TEN])) == as_set(both.filter("hour = '10'"))
    with pytest.raises(FileNotFoundError, match="2026-05-05-08"):
        landing.read_landing(spark, folder, [NINE, EIGHT])
    land(folder, Batch("2026-05-06", "09"), [])
    open(f"{folder}/mdt_records_2026-05-05-xx.csv", "w").close()
    assert landing.landed(spark, folder, Batch.day(DAY)) == [NINE, TEN]
    with pytest.raises(ValueError, match="leading"):
        landing.batch_of_file("{date}-{hour}.csv")


def test_malformed_numbers_are_null(spark, tmp_path):
    folder = str(tmp_path / "landing")
    land(folder, NINE, [measurement(p_cell_rsrp="n/a", lat="north", cell_id=None)])
    row = landing.read_landing(spark, folder, [NINE]).first()
    assert (row.p_cell_rsrp, row.lat, row.cell_id, row.lng) == (None, None, None, 105.84)
    assert "north" in row.unreadable


def test_decimals_and_rows_that_do_not_fit(spark, tmp_path):
    folder = str(tmp_path / "landing")
    land(folder, NINE, [measurement(p_cell_rsrp=v) for v in ("-97.0", "-97", "-97.5", "1e12", "")])
    rows = landing.read_landing(spark, folder, [NINE]).collect()
    assert [r.p_cell_rsrp for r in rows] == [-97, -97, None, None, None]
    assert [r.unreadable for r in rows] == [None, None, "p_cell_rsrp=-97.5", "p_cell_rsrp=1.0E12", None]

    land(folder, TEN, [measurement(hour="10")])
    good = open(f"{folder}/mdt_records_2026-05-05-10.csv").read().splitlines()
    broken = [good[0], good[1], good[1] + ",more", "1,2", good[1].replace(",a", ',"a\nb"')]
    open(f"{folder}/mdt_records_2026-05-05-10.csv", "w").write("\n".join(broken))
    df = landing.read_landing(spark, folder, [TEN])
    # a line broken inside quotes is two rows, of which the second is too short
    assert df.where("unreadable IS NULL").count() == 2
    assert df.select("cell_id").where("unreadable IS NOT NULL").count() == 3


def test_the_shared_folder_is_the_clusters(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert Workspace(spark).root.startswith(shared_folder(spark))


class Session:
    """Just the settings of a session."""

    def __init__(self, **settings):
        self.conf = self
        self.settings = settings

    def get(self, name, default=None):
        return self.settings.get(name.replace(".", "_"), default)


def test_a_cluster_without_a_shared_folder_is_refused():
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]", "k8s://x"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared_folder(Session(spark_master=master))
        named = Session(spark_master=master, spark_checkpoint_dir="s3a://scratch/")
        assert shared_folder(named) == "s3a://scratch"
    assert os.path.isdir(shared_folder(Session(spark_master="local[8]")))
