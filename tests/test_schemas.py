import pytest

from celltide.schemas import Batch, in_batches, in_batches_sql


@pytest.mark.parametrize(
    "date, hour",
    [("2026-05-05", "9"), ("2026-5-5", "09"), ("2026-05-05", "24"), ("2026-02-30", "00"),
     ("2026-05-05' OR '1'='1", "09"), ("2026-05-05", None), (None, "09")],
)
def test_batch_rejects_other_forms(date, hour):
    with pytest.raises(ValueError):
        Batch(date, hour)


def test_range_crosses_midnight():
    got = Batch.range(Batch("2026-02-28", "22"), Batch("2026-03-01", "01"))
    assert [b.key for b in got] == [
        "2026-02-28-22", "2026-02-28-23", "2026-03-01-00", "2026-03-01-01",
    ]
    assert len(Batch.day("2026-05-05")) == 24
    assert Batch.parse("2026-05-05-09") == Batch("2026-05-05", "09")


def test_batch_filter_selects_exactly_the_batches(spark):
    wanted = Batch.range(Batch("2026-05-05", "22"), Batch("2026-05-07", "01"))
    every = Batch.range(Batch("2026-05-04", "00"), Batch("2026-05-08", "23"))
    df = spark.createDataFrame([(b.date, b.hour) for b in every], "date string, hour string")
    for condition in (in_batches(wanted), in_batches_sql(wanted)):
        got = {Batch(r.date, r.hour) for r in df.filter(condition).collect()}
        assert got == set(wanted)
    assert df.filter(in_batches([])).count() == 0
    assert df.filter(in_batches_sql([])).count() == 0
