import random

import pytest
from helpers import as_set, land, measurement
from pyspark.sql import functions as F

from celltide import schemas
from celltide.operators import kpi, states
from celltide.plans.medallion import Lakehouse, Settings, run_range
from celltide.schemas import Batch

SCHEMA = "date string, hour string, h3_index string, cell_id string, p_cell_rsrp int, distance_to_cell_km double, cell_lat double, cell_lon double"


def enriched(spark, n=3000):
    r = random.Random(4)
    rows = []
    for i in range(n):
        cell = "hot" if i % 3 == 0 else r.choice(["a", "b", None])
        signal = None if r.random() < 0.05 or cell is None and r.random() < 0.5 else r.choice([-140, -44, r.randint(-140, -44)])
        km = None if r.random() < 0.1 else r.random() * 9
        rows.append(("2026-05-05", f"{r.randrange(5):02d}", r.choice(["h1", "h2", None]), cell, signal, km, 21.5, 105.8))
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize(
    "keys", [kpi.GOLD_KEYS, ("date", "h3_index", "cell_id"), ("date", "hour", "h3_index"), ("cell_id",), ("date",)]
)
def test_merged_states_give_what_measurements_give(spark, keys):
    rows = enriched(spark)
    stored = states.states(rows)
    columns = [*keys, "user_density_count", "avg_rsrp", "p10_rsrp", "avg_distance_km", "weak_signal_ratio"]
    found = states.indicators(states.merged(stored, keys))
    assert as_set(found, *columns) == as_set(kpi.indicators(rows, keys), *columns)


def test_merging_in_steps_gives_the_same_state(spark):
    stored = states.states(enriched(spark))
    at_once = states.merged(stored, ("date",))
    in_steps = states.merged(states.merged(states.merged(stored, ("date", "hour", "h3_index")), ("date", "h3_index")), ("date",))
    rounded = lambda df: as_set(df.withColumn("km_sum", F.round("km_sum", 6)))
    assert rounded(in_steps) == rounded(at_once)


def test_percentiles_agree_for_every_size(spark):
    sizes = spark.range(1, 131).select(F.col("id").alias("g"), F.explode(F.sequence(F.lit(1), "id")).alias("k"))
    rows = sizes.select(
        F.col("g").cast("string").alias("date"), (-44 - F.pmod(F.col("k") * 37, F.lit(97))).cast("int").alias("p_cell_rsrp"),
        F.lit(1.0).alias("distance_to_cell_km"),
    )
    for share in (0.1, 0.5, 0.9):
        exact = rows.groupBy("date").agg(F.expr(f"percentile_disc({share}) WITHIN GROUP (ORDER BY p_cell_rsrp)").cast("int").alias("p"))
        found = states.states(rows, ("date",)).select("date", states.percentile(share).alias("p"))
        assert as_set(found) == as_set(exact)


def test_a_state_is_bounded(spark):
    rows = spark.range(200_000).select(
        F.lit("x").alias("date"), (-44 - F.col("id") % 97).cast("int").alias("p_cell_rsrp"), F.lit(1.0).alias("distance_to_cell_km")
    )
    state = states.states(rows, ("date",)).first()
    assert (state.samples, len(state.signals), state.km_sum) == (200_000, 97, 200_000.0)
    assert [s.value for s in state.signals] == list(range(-140, -43))


def test_no_rows_give_no_states(spark):
    assert states.merged(states.states(enriched(spark).limit(0)), ("date",)).isEmpty()


def test_a_day_rolls_up_without_its_measurements(spark, tmp_path):
    hours = [Batch("2026-05-05", h) for h in ("08", "09")]
    for b in hours:
        rows = [measurement(hour=b.hour, cell_id=c, p_cell_rsrp=-80 - 3 * i) for i, c in enumerate("aaabbbbab")]
        land(str(tmp_path / "landing"), b, rows)
    lake = Lakehouse(spark, Settings(str(tmp_path / "landing"), str(tmp_path / "lake"), states=True))
    cells = spark.createDataFrame([("a", 21.5, 105.8)], schemas.CELL_INFO)
    run_range(lake, hours, cells)
    day = lake.roll_up(hours)
    columns = ["date", "h3_index", "cell_id", "user_density_count", "avg_rsrp", "p10_rsrp", "avg_distance_km", "weak_signal_ratio"]
    assert as_set(day, *columns) == as_set(kpi.indicators(lake.enriched.scan(), ("date", "h3_index", "cell_id")), *columns)
    assert all("gold/mdt_states" in f for f in day.inputFiles())

    land(str(tmp_path / "landing"), hours[0], [measurement(hour="08", lat=0.0, lng=0.0, p_cell_rsrp=-150, p_cell_rsrq=0.0, date_hour="x")])
    run_range(lake, hours, cells)  # a blocked hour leaves the states too
    assert {r.hour for r in lake.states.scan().collect()} == {"09"}
