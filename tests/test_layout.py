import pytest
from helpers import as_set, land, measurement
from pyspark.sql import functions as F

from celltide import schemas
from celltide.functions.morton import BITS, clustered, in_box, morton
from celltide.operators import sketches
from celltide.plans.medallion import Lakehouse, Settings, run_range
from celltide.schemas import Batch, RadioDomain
from celltide.sources.compact import compact, pack, plan
from celltide.sources.lake import LakeTable

DAY = [Batch("2026-05-05", h) for h in ("07", "08", "09")]
SCHEMA = "id bigint, lat double, lng double, date string, hour string"


def rows(spark, n=20_000):
    hour = F.concat(F.lit("0"), (7 + F.col("id") % 3).cast("string"))
    spread = lambda seed: F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(100_000)) / 100_000.0
    return spark.range(n).select(
        "id", (8.5 + 14.9 * spread(1)).alias("lat"), (102.1 + 7.4 * spread(2)).alias("lng"), F.lit("2026-05-05").alias("date"), hour.alias("hour")
    )


def table(spark, workspace, name, leading=()):
    schema = rows(spark, 1).schema
    return LakeTable(spark, workspace.path(name), schema, leading)


def test_files_are_packed_first_fit_by_decreasing_size():
    bins = pack({"a": 60, "b": 50, "c": 40, "d": 30, "e": 10, "f": 250}, 100)
    assert bins.n_bins == 5
    assert bins.files["f"] == (0, 3)
    assert bins.files["a"] == bins.files["c"] == (3, 1)
    assert {bins.files[n] for n in "bde"} == {(4, 1)}
    assert pack({}, 100).n_bins == 0


def test_hours_of_many_small_files_are_rewritten(spark, workspace):
    lake = table(spark, workspace, "scattered")
    lake.replace(rows(spark).where("hour != '09'").repartition(7), DAY)
    lake.replace(rows(spark).where("hour = '09'").coalesce(1), DAY[2:])
    before, sizes = as_set(lake.scan()), lake.file_sizes(DAY)
    assert [len(s) for s in sizes.values()] == [7, 7, 1]
    moved = compact(lake, DAY)
    assert moved == {("2026-05-05", "07"): (7, 1), ("2026-05-05", "08"): (7, 1)}
    assert as_set(lake.scan()) == before
    assert lake.file_sizes(DAY)[("2026-05-05", "09")] == sizes[("2026-05-05", "09")]  # not touched
    assert compact(lake, DAY) == {} == plan(lake, DAY)


def test_files_come_near_the_target_and_large_ones_are_split(spark, workspace):
    lake = table(spark, workspace, "sized")
    lake.replace(rows(spark).repartition(12), DAY)
    before, total = as_set(lake.scan()), sum(lake.file_sizes(DAY[:1])[("2026-05-05", "07")].values())
    target = total // 3
    moved = compact(lake, DAY, target)
    assert len(moved) == 3 and all(after <= 5 for _, after in moved.values())
    assert as_set(lake.scan()) == before
    compact(lake, DAY, 10 * total)
    assert all(len(s) == 1 for s in lake.file_sizes(DAY).values())
    moved = compact(lake, DAY, total // 4)
    assert all(after >= 4 for _, after in moved.values())
    assert as_set(lake.scan()) == before


def test_branches_of_an_hour_are_packed_apart(spark, workspace):
    split = rows(spark, 3000).withColumn("verdict", F.when(F.col("id") % 4 == 0, "dirty").otherwise("clean"))
    lake = LakeTable(spark, workspace.path("checked"), split.schema, ("verdict",))
    lake.replace(split.repartition(5), DAY)
    before = as_set(lake.scan())
    moved = compact(lake, DAY[:2])
    assert {values[:1] + values[2:] for values in moved} == {(v, h) for v in ("clean", "dirty") for h in ("07", "08")}
    assert as_set(lake.scan()) == before


def test_an_empty_table_is_left_alone(spark, workspace):
    assert compact(table(spark, workspace, "none"), DAY) == {}


def test_a_run_compacts_its_tables(spark, tmp_path):
    for b in DAY:
        land(str(tmp_path / "landing"), b, [measurement(hour=b.hour, cell_id=f"c{i % 5}", lat=21.5 + i / 1000) for i in range(40)])
    cells = spark.createDataFrame([("c1", 21.5, 105.8)], schemas.CELL_INFO)
    lake = Lakehouse(spark, Settings(str(tmp_path / "landing"), str(tmp_path / "lake"), compact_bytes=1 << 20))
    run_range(lake, DAY, cells)
    before = as_set(lake.enriched.scan())
    lake.enriched.replace(lake.workspace.stage(lake.enriched.scan(), "copy").repartition(6), DAY)
    assert lake.compact(DAY) == {"bronze": 0, "checked": 0, "enriched": 3}
    assert as_set(lake.enriched.scan()) == before


def test_the_enriched_table_may_follow_the_curve(spark, tmp_path):
    for b in DAY:
        rows_ = [measurement(hour=b.hour, cell_id=f"c{i % 5}", lat=21.5 + i / 1000, lng=105.8 + (i * 7 % 40) / 1000) for i in range(40)]
        land(str(tmp_path / "landing"), b, rows_)
    cells = spark.createDataFrame([("c1", 21.5, 105.8)], schemas.CELL_INFO)
    plain, curved = (
        Lakehouse(spark, Settings(str(tmp_path / "landing"), str(tmp_path / name), curve_files=n)) for name, n in (("plain", 0), ("curved", 2))
    )
    columns = [c for c in schemas.ENRICHED.names if c != "processed_at"]
    for lake in (plain, curved):
        run_range(lake, DAY, cells)
    assert as_set(curved.enriched.scan(), *columns) == as_set(plain.enriched.scan(), *columns)
    box = ((21.51, 21.52), (105.8, 105.83))
    found = as_set(curved.box(DAY[:2], *box), *columns)
    assert found and found == as_set(plain.box(DAY[:2], *box), *columns)
    assert max(len(s) for s in curved.enriched.file_sizes(DAY).values()) <= 3


def bits_in_turn(lat, lng, domain=RadioDomain()):
    def step(v, low, high):
        return min(max(int((v - low) / (high - low) * (1 << BITS)), 0), (1 << BITS) - 1)

    a, b = step(lat, *domain.lat), step(lng, *domain.lng)
    return sum(((a >> i & 1) << 2 * i + 1) | ((b >> i & 1) << 2 * i) for i in range(BITS))


def test_keys_take_bits_of_both_coordinates_in_turn(spark):
    points = [(8.5, 102.1), (23.4, 109.5), (21.55, 105.84), (0.0, 200.0), (12.34, 107.77)]
    found = spark.createDataFrame(points, "lat double, lng double").select("lat", "lng", morton(F.col("lat"), F.col("lng")).alias("k"))
    assert {(r.lat, r.lng): r.k for r in found.collect()} == {p: bits_in_turn(*p) for p in points}
    odd = spark.createDataFrame([(None, 105.0), (float("nan"), float("inf"))], "lat double, lng double")
    assert all(r.k is not None for r in odd.select(morton(F.col("lat"), F.col("lng")).alias("k")).collect())


def scanned(df):
    """Rows that come out of the scan of a filter's plan, after pruning."""
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    leaves, plan_ = [], execution.executedPlan()
    todo = [plan_]
    while todo:
        node = todo.pop()
        children = node.children()
        if children.isEmpty():
            leaves.append(node)
        todo += [children.apply(i) for i in range(children.size())]
    return sum(n.metrics().apply("numOutputRows").value() for n in leaves)


def test_a_box_reads_few_row_groups(spark, workspace):
    data = rows(spark, 60_000)
    box = in_box((20.0, 20.9), (105.0, 105.5))
    name = "parquet.block.size"
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set(name, "16384")
    try:
        along, across = table(spark, workspace, "along"), table(spark, workspace, "across")
        along.replace(clustered(data, 12), DAY)
        across.replace(data.repartition(12), DAY)
    finally:
        conf.unset(name)
    found = along.scan().filter(box)
    assert as_set(found) == as_set(data.filter(box))
    assert "PushedFilters: [IsNotNull(lat), IsNotNull(lng), GreaterThanOrEqual(lat" in found._jdf.queryExecution().executedPlan().toString()
    assert scanned(across.scan().filter(box)) > 50_000
    assert scanned(along.scan().filter(box)) < 25_000


def test_one_position_of_many_rows_is_split(spark):
    same = rows(spark, 9000).withColumns({"lat": F.lit(21.0), "lng": F.lit(105.0), "time_ms": F.col("id").cast("double")})
    sizes = clustered(same, 9).groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in sizes) < 2500


def test_sketches_stay_within_their_error(spark):
    data = rows(spark, 60_000)
    found = sketches.sketches(data, ["hour"], "lat").select("hour", "n", sketches.quantile(0.1, "p10"))
    for r in found.collect():
        below = data.where((F.col("hour") == r.hour) & (F.col("lat") <= r.p10)).count() / r.n
        assert abs(below - 0.1) <= 2 * sketches.rank_error()


def test_sketches_of_hours_merge(spark):
    data = rows(spark, 30_000).withColumn("lat", F.when(F.col("id") % 11 == 0, None).otherwise(F.col("lat")))
    merged = sketches.merged(sketches.sketches(data, ["date", "hour"], "lat"), ["date"])
    r = merged.select("n", sketches.quantile(0.5, "median")).first()
    assert r.n == data.where("lat IS NOT NULL").count()
    below = data.where(F.col("lat") <= r.median).count() / r.n
    assert abs(below - 0.5) <= 2 * sketches.rank_error()


def test_a_sketch_of_no_values_has_no_quantile(spark):
    none = spark.createDataFrame([("a", None)], "k string, v double")
    assert sketches.sketches(none, ["k"], "v").select("n", sketches.quantile(0.1, "q")).first() == (0, None)


@pytest.mark.parametrize("k", [200, 400])
def test_the_error_falls_with_size(k):
    assert sketches.rank_error(2 * k) < sketches.rank_error(k) < 0.03
