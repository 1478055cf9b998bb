"""The registered queries: each operator over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from celltide import schemas
from celltide.functions.geo import law_of_cosines_km
from celltide.functions.grid import HexGrid
from celltide.operators import enrich as en
from celltide.functions.morton import clustered, in_box
from celltide.operators import kpi, quality, serve, sketches, states
from celltide.operators.digest import reconciled
from celltide.operators.joins import Lookup
from celltide.plans.medallion import Lakehouse, Settings, run_changed, run_range
from celltide.schemas import Batch
from celltide.sources import landing
from celltide.sources.compact import compact
from celltide.sources.derived import DATE, cell_info, measurements
from celltide.sources.lake import LakeTable
from celltide.sources.workspace import Workspace

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

DAY = Batch.day(DATE)


def registered(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.accepted(measurements(spark, sf_dir))


def _positions(spark: SparkSession, sf_dir: str, clean: DataFrame) -> Lookup:
    sites = en.site_lookup(cell_info(spark, sf_dir))
    return en.cell_positions(clean, sites, Workspace(spark))


def _filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = _clean(spark, sf_dir)
    return en.attach_positions(clean, _positions(spark, sf_dir, clean))


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = _clean(spark, sf_dir)
    return en.enrich(clean, _positions(spark, sf_dir, clean))


def _gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi.gold(_enriched(spark, sf_dir))


def _rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    # Means of short decimals sit on rounding ties, where the last bit of a sum
    # decides; the nudge moves them off, far below the digits kept.
    return df.withColumns({c: F.round(F.col(c) + 1e-9, digits) for c in columns})


def _rounded_ends(df: DataFrame) -> DataFrame:
    return _rounded(df, 6, "cell_lat", "cell_lon", "h3_center_lat", "h3_center_lon")


# --- sources and sinks -------------------------------------------------------


def _land(spark: SparkSession, sf_dir: str, workspace: Workspace) -> tuple[str, str]:
    """Write the measurements as landing files, one directory per hour."""
    folder = workspace.path("landing")
    _deliver(measurements(spark, sf_dir), folder)
    return folder, "slot={date}-{hour}"


def _deliver(rows: DataFrame, folder: str) -> None:
    """Landing files of the rows' hours; those that were there are replaced."""
    columns = [
        F.col(f.name) if f.name not in ("province_name", "district_name")
        else F.lit(None).cast(f.dataType).alias(f.name)
        for f in schemas.LANDING
    ]
    (
        rows.select(*columns, F.concat_ws("-", "date", "hour").alias("slot"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("slot")
        .option("header", True)
        .csv(folder)
    )


@registered
def src_csv_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, name = _land(spark, sf_dir, Workspace(spark))
    return landing.read_landing(spark, folder, DAY, name)


@registered
def src_csv_decimals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing files whose signal is written -97.0, with rows too long, too short, or with a fraction."""
    rows = measurements(spark, sf_dir)
    names = [f.name for f in schemas.LANDING]
    signal = F.when(F.col("event_id") % 29 == 5, F.lit("-97.5")).otherwise(
        F.concat(F.col("p_cell_rsrp").cast("string"), F.lit(".0"))
    )
    texts = {n: F.col(n).cast("string") if n in rows.columns else F.lit("") for n in names}
    texts["p_cell_rsrp"] = signal
    fields = [F.coalesce(texts[n], F.lit("")) for n in names]
    line = (
        F.when(F.col("event_id") % 31 == 7, F.concat_ws(",", *fields, F.lit("surplus")))
        .when(F.col("event_id") % 37 == 9, F.concat_ws(",", *fields[:5]))
        .otherwise(F.concat_ws(",", *fields))
    )
    folder = Workspace(spark).path("landing")
    lines = rows.select(line.alias("value"), F.concat_ws("-", "date", "hour").alias("slot"))
    head = spark.createDataFrame([(",".join(names), b.key) for b in DAY], "value string, slot string")
    # one file per hour, its header first
    whole = head.withColumn("first", F.lit(True)).unionByName(lines.withColumn("first", F.lit(False)))
    ordered = whole.repartition("slot").sortWithinPartitions("slot", F.col("first").desc())
    ordered.drop("first").write.partitionBy("slot").text(folder)
    landed = landing.read_landing(spark, folder, DAY, "slot={date}-{hour}")
    return landed.groupBy(*schemas.BATCH_KEYS).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("unreadable").alias("n_unreadable"),
        F.count("p_cell_rsrp").alias("n_signals"),
        F.sum("p_cell_rsrp").alias("sum_signal"),
        F.count("cell_id").alias("n_cells"),
    )


def _headed_lines(rows: DataFrame) -> tuple[list[str], DataFrame]:
    """Headers of five kinds of files and one that lacks a needed column; lines with their ``kind``, by hour."""
    names = [f.name for f in schemas.LANDING]
    text = {n: F.coalesce(F.col(n).cast("string") if n in rows.columns else F.lit(""), F.lit("")) for n in names}
    text["operator"] = F.concat(F.lit("op"), (F.col("event_id") % 3).cast("string"))
    kinds = [
        names,
        names[::-1],
        [n for n in names if n not in ("province_name", "district_name", "cell_id")],
        ["operator", *names, ""],
        [f" {n.upper()} " for n in names],
        [n for n in names if n != "lat"],
    ]
    kind = F.when(F.col("hour") == "23", 5).otherwise(F.col("hour").cast("int") % 5)
    line = F.lit(None)
    for k, header in enumerate(kinds):
        fields = [text.get(n.strip().lower(), F.lit("x")) for n in header]
        line = F.when(kind == k, F.concat_ws(",", *fields)).otherwise(line)
    return [",".join(h) for h in kinds], rows.select(line.alias("value"), F.concat_ws("-", "date", "hour").alias("slot"))


@registered
def src_csv_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing files whose columns are moved, missing, added or otherwise spelled; the file of 23 h cannot be mapped."""
    headers, lines = _headed_lines(measurements(spark, sf_dir))
    kinds = [(headers[5 if b.hour == "23" else int(b.hour) % 5], b.key) for b in DAY]
    head = spark.createDataFrame(kinds, "value string, slot string")
    whole = head.withColumn("first", F.lit(True)).unionByName(lines.withColumn("first", F.lit(False)))
    ordered = whole.repartition("slot").sortWithinPartitions("slot", F.col("first").desc())
    folder, name = Workspace(spark).path("landing"), "slot={date}-{hour}"
    ordered.drop("first").write.partitionBy("slot").text(folder)
    found = landing.layout(spark, landing.landing_files(spark, folder, DAY, name))
    rows = landing.read_layout(spark, found, name, extra=True)
    return rows.withColumn("operator", F.col("extra")["operator"]).drop("extra")


def _measurement_table(spark: SparkSession, sf_dir: str) -> tuple[LakeTable, DataFrame]:
    rows = measurements(spark, sf_dir)
    table = LakeTable(spark, Workspace(spark).path("mdt"), rows.schema)
    table.replace(rows, DAY)
    return table, rows


@registered
def src_partition_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, _ = _measurement_table(spark, sf_dir)
    return table.scan([Batch(DATE, "09")])


@registered
def src_missing_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is there of two tables, of which one was never written."""
    written, rows = _measurement_table(spark, sf_dir)
    never = LakeTable(spark, Workspace(spark).path("never"), rows.schema)
    found = []
    for name, table in (("written", written), ("never", never)):
        scan = table.scan_if_present(DAY[:6])
        counted = None if scan is None else scan.agg(F.count(F.lit(1)).alias("n_rows"))
        none = spark.range(1).select(F.lit(0).cast("bigint").alias("n_rows"))
        found.append((none if counted is None else counted).select(F.lit(name).alias("name"), F.lit(scan is not None).alias("present"), "n_rows"))
    return found[0].unionByName(found[1])


@registered
def src_cell_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return en.cell_sites(cell_info(spark, sf_dir))


@registered
def snk_replace_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, rows = _measurement_table(spark, sf_dir)
    corrected = quality.accepted(rows).filter(F.col("hour") == "05")
    table.replace(corrected, [Batch(DATE, "05"), Batch(DATE, "07")])
    return table.scan()


@registered
def snk_schema_evolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    workspace = Workspace(spark)
    gold = workspace.stage(_gold(spark, sf_dir), "gold")
    kept = ["h3_index", "cell_id", "user_density_count", *schemas.BATCH_KEYS]
    before = gold.select(*kept)
    table = LakeTable(spark, workspace.path("evolving"), before.schema)
    table.replace(before.filter("hour < '12'"), DAY[:12])
    table.replace(gold.filter("hour >= '12'").select("weak_signal_ratio", *kept), DAY[12:])
    return table.scan()


@registered
def snk_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table written in many small files, and what its hours hold in how many files after compaction."""
    rows = measurements(spark, sf_dir)
    table = LakeTable(spark, Workspace(spark).path("scattered"), rows.schema)
    table.replace(rows.repartition(6), DAY)
    compact(table, DAY)
    per_hour = table.scan().groupBy(*schemas.BATCH_KEYS)
    return per_hour.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("event_id").alias("sum_event_id"),
        F.count_distinct(F.col("_metadata.file_name")).alias("n_files"),
    )


@registered
def publish_gold_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_ends(serve.spatial_rows(_gold(spark, sf_dir)))


@registered
def publish_audit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the audit table is given: its own columns, of hours whose report is stored."""
    stored = LakeTable(spark, Workspace(spark).path("reports"), schemas.REPORT)
    stored.replace(quality.report(measurements(spark, sf_dir)), DAY)
    return stored.scan(DAY).select(*schemas.AUDIT_COLUMNS).drop("created_at")


# --- projections and filters -------------------------------------------------


@registered
def prj_batch_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    bare = measurements(spark, sf_dir).drop("date", "hour")
    return landing.with_batch(bare.select("event_id", "date_hour"), Batch(DATE, "09"))


@registered
def prj_try_cast_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = measurements(spark, sf_dir).select(
        "event_id",
        F.coalesce(F.col("lat").cast("string"), F.lit("n/a")).alias("lat"),
        F.coalesce(F.col("lng").cast("string"), F.lit("")).alias("lng"),
    )
    return en.typed_positions(texts, "lat", "lng")


@registered
def prj_record_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measurements(spark, sf_dir).select("event_id", serve.record_time())


@registered
def prj_processing_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checked rows of each hour, and how many carry a time within the run that checked them."""
    lake = _landed_lake(spark, sf_dir)
    began = spark.range(1).select(F.current_timestamp().alias("t")).first().t
    lake.ingest(DAY)
    lake.check(DAY)
    within = F.col("processed_at").between(F.lit(began), F.current_timestamp())
    return lake.checked.scan(DAY).groupBy(*schemas.BATCH_KEYS).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(within).alias("n_stamped"), F.count_distinct("processed_at").alias("n_times")
    )


@registered
def flt_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clean(spark, sf_dir)


@registered
def flt_time_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = serve.between_times(
        _gold(spark, sf_dir), f"{DATE} 06:00:00", f"{DATE} 11:00:00"
    )
    return chosen.select(
        "h3_index", "cell_id", "user_density_count", "avg_rsrp", *schemas.BATCH_KEYS
    )


@registered
def flt_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measurements within a box, from a table laid out along the Morton curve."""
    rows = measurements(spark, sf_dir)
    table = LakeTable(spark, Workspace(spark).path("clustered"), rows.schema)
    table.replace(clustered(rows, 2 * len(DAY)), DAY)
    return table.scan().filter(in_box((21.505, 21.521), (105.805, 105.832)))


# --- data quality ------------------------------------------------------------


@registered
def dq_rule_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rule_violations(measurements(spark, sf_dir), quality.radio_rules())


@registered
def dq_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.summary(measurements(spark, sf_dir), quality.radio_rules())


@registered
def dq_split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.split_counts(measurements(spark, sf_dir)).drop("undecided_count")


@registered
def dq_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rejected(measurements(spark, sf_dir))


@registered
def dq_quarantine_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rejected(measurements(spark, sf_dir), null_policy="drop")


@registered
def dq_null_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = quality.split_counts(measurements(spark, sf_dir))
    return counts.select(*schemas.BATCH_KEYS, "undecided_count")


@registered
def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    drops = quality.report(measurements(spark, sf_dir), null_policy="drop")
    return drops.drop("created_at")


@registered
def dq_console_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report_lines(quality.report(measurements(spark, sf_dir)))


@registered
def dq_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.gate(quality.report(measurements(spark, sf_dir)))


@registered
def dq_generic_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [
        quality.not_null("o_custkey"),
        quality.between("o_totalprice", 1000.0, 400000.0),
        quality.length_between("o_orderpriority", 5, 8),
        quality.in_set("o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM"]),
        quality.not_in_set("o_orderstatus", ["P"]),
    ]
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return quality.rule_violations(orders, rules, ["o_orderstatus"])


@registered
def dq_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measurements against their clean and rejected rows, of which one is lost, one repeated and one altered."""
    rows = measurements(spark, sf_dir)
    table = LakeTable(spark, Workspace(spark).path("split"), rows.schema, ("verdict",))
    split = quality.with_verdict(rows).where("event_id != 243")
    split = split.unionByName(split.where("event_id = 245"))
    altered = F.when(F.col("event_id") == 247, F.lit("elsewhere")).otherwise(F.col("cell_id"))
    table.replace(split.withColumn("cell_id", altered), DAY)
    sides = [table.scan().where(F.col("verdict") == v).drop("verdict") for v in ("clean", "dirty")]
    return reconciled(rows, sides, [c for c in rows.columns if c not in schemas.BATCH_KEYS])


@registered
def dq_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact repeats: every tenth measurement twice, and one a thousand times."""
    rows = measurements(spark, sf_dir)
    thousand = rows.where("event_id = 31").withColumn("_n", F.explode(F.sequence(F.lit(2), F.lit(1000)))).drop("_n")
    more = rows.where("event_id % 10 = 0").unionByName(thousand)
    return quality.repeats(rows.unionByName(more))


# --- grid, sites, distance ---------------------------------------------------


@registered
def geo_hex_bin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measured positions, some of them no number, infinite, beyond a pole or once more round the globe."""
    case = F.col("event_id") % 97
    lat = F.when(case == 1, float("nan")).when(case == 2, 91.0).when(case == 3, float("-inf"))
    lng = F.when(case == 4, float("nan")).when(case == 5, float("inf"))
    lng = lng.when(case == 6, F.col("lng") + 360.0).when(case == 7, F.col("lng") - 720.0)
    odd = {"lat": lat.otherwise(F.col("lat")), "lng": lng.otherwise(F.col("lng"))}
    binned = HexGrid().assign(measurements(spark, sf_dir).withColumns(odd), "lat", "lng")
    return binned.select("event_id", "h3_index")


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return HexGrid().assign(_clean(spark, sf_dir), "lat", "lng").select("h3_index").distinct()


@registered
def geo_hex_center(spark: SparkSession, sf_dir: str) -> DataFrame:
    centres = HexGrid().add_centre(
        _cells(spark, sf_dir), "h3_index", "h3_center_lat", "h3_center_lon"
    )
    return _rounded(centres, 7, "h3_center_lat", "h3_center_lon")


@registered
def geo_hex_wkt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return HexGrid().add_outline(_cells(spark, sf_dir), "h3_index")


@registered
def geo_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = en.add_distance(_filled(spark, sf_dir))
    return _rounded(measured.select("event_id", "distance_to_cell_km"), 6, "distance_to_cell_km")


@registered
def geo_distance_slc(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = _filled(spark, sf_dir)
    ends = [F.col(c) for c in ("lat", "lng", "cell_lat", "cell_lon")]
    return filled.select(
        "event_id", F.round(law_of_cosines_km(*ends), 2).alias("distance_to_cell_km")
    )


@registered
def enr_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    sites = en.site_lookup(cell_info(spark, sf_dir))
    sited = en.attach_sites(_clean(spark, sf_dir), sites)
    return sited.select("event_id", "cell_id", "cell_lat", "cell_lon")


@registered
def enr_unmatched_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return en.unmatched_cells(_clean(spark, sf_dir), cell_info(spark, sf_dir))


@registered
def enr_cell_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    centroids = en.cell_centroids(_clean(spark, sf_dir))
    return _rounded(centroids, 6, "est_cell_lat", "est_cell_lon")


def _sited(filled: DataFrame) -> DataFrame:
    sites = filled.select("event_id", "cell_id", "cell_lat", "cell_lon", "cell_pos_source")
    return _rounded(sites, 6, "cell_lat", "cell_lon")


@registered
def enr_fill_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sited(_filled(spark, sf_dir))


def _without_broadcast(spark: SparkSession, build: Callable[[], DataFrame]) -> DataFrame:
    """A frame planned as if its lookups were too large to broadcast."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        return build()
    finally:
        spark.conf.set(name, before)


@registered
def enr_fill_site_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _without_broadcast(spark, lambda: _sited(_filled(spark, sf_dir)))


@registered
def enr_fill_site_skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of all measurements in one cell, and lookups that are not broadcast."""
    crowded = F.when(F.col("event_id") % 3 == 0, F.lit("c30")).otherwise(F.col("cell_id"))
    clean = _clean(spark, sf_dir).withColumn("cell_id", crowded)

    def build() -> DataFrame:
        return _sited(en.attach_positions(clean, _positions(spark, sf_dir, clean)))

    return _without_broadcast(spark, build)


# --- indicators --------------------------------------------------------------


@registered
def gold_kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi.indicators(_enriched(spark, sf_dir), kpi.GOLD_KEYS)


@registered
def gold_kpi_coords(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_ends(_gold(spark, sf_dir))


@registered
def gold_p10_per_cell(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clean(spark, sf_dir).groupBy("cell_id").agg(kpi.weakest_tenth())


@registered
def gold_weak_share_per_cell(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clean(spark, sf_dir).groupBy("cell_id").agg(kpi.weak_share())


@registered
def gold_by_hex(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi.by_hex(_enriched(spark, sf_dir))


@registered
def gold_by_cell(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi.by_cell(_enriched(spark, sf_dir))


def _stored_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The states of every hour, as a table that was written hour by hour."""
    table = LakeTable(spark, Workspace(spark).path("states"), states.STATE)
    table.replace(states.states(_enriched(spark, sf_dir)).select(*states.STATE.names), DAY, rebalance=True)
    return table.scan(DAY)


@registered
def gold_day_from_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The day's indicators, from the stored states of its hours."""
    day = states.merged(_stored_states(spark, sf_dir), ("date", "h3_index", "cell_id"))
    return states.indicators(day).drop("cell_lat", "cell_lon")


@registered
def gold_hex_from_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hexagons' indicators, from the stored states of hexagons and cells."""
    hexes = states.merged(_stored_states(spark, sf_dir), (*schemas.BATCH_KEYS, "h3_index"))
    return states.indicators(hexes).drop("cell_lat", "cell_lon")


@registered
def prj_array_element(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weakest and strongest signal of each group: the first and last elements of its state's list."""
    found = states.extremes(states.states(_enriched(spark, sf_dir)))
    return found.select(*kpi.GOLD_KEYS, "weakest_rsrp", "strongest_rsrp")


@registered
def gold_p10_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tenth percentile of order prices from merged sketches: whether its true rank is within the stated error."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    price = F.col("o_totalprice").cast("double")
    parts = sketches.sketches(orders, ["o_orderpriority", "o_orderstatus"], "o_totalprice")
    found = sketches.merged(parts, ["o_orderpriority"]).select("o_orderpriority", "n", sketches.quantile(0.1, "p10"))
    ranked = orders.select("o_orderpriority", price.alias("price")).join(found, "o_orderpriority")
    shares = ranked.groupBy("o_orderpriority").agg(
        F.max("n").alias("n"),
        F.avg(F.when(F.col("price") < F.col("p10"), 1.0).otherwise(0.0)).alias("below"),
        F.avg(F.when(F.col("price") <= F.col("p10"), 1.0).otherwise(0.0)).alias("up_to"),
    )
    error = 2 * sketches.rank_error()  # twice the bound of 99 %, so that chance does not decide
    within = (F.col("below") <= 0.1 + error) & (F.col("up_to") >= 0.1 - error)
    return shares.select("o_orderpriority", "n", within.alias("within_error"))


# --- serving and whole runs --------------------------------------------------


@registered
def serve_map_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_ends(serve.map_day(_gold(spark, sf_dir), DATE))


@registered
def serve_arcs(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = serve.arcs(serve.map_rows(_gold(spark, sf_dir)))
    return _rounded(lines, 6, "lat0", "lng0", "lat1", "lng1")


@registered
def serve_signal_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    classed = serve.with_signal_class(serve.map_rows(_gold(spark, sf_dir)))
    return classed.select(
        "h3_index", "cell_id", "record_time", "avg_rsrp", "signal_class", "signal_colour"
    )


@registered
def serve_audit_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    audit = serve.audit_day(quality.report(measurements(spark, sf_dir)), DATE)
    return audit.drop("created_at")


def _landed_lake(spark: SparkSession, sf_dir: str) -> Lakehouse:
    workspace = Workspace(spark)
    folder, name = _land(spark, sf_dir, workspace)
    return Lakehouse(spark, Settings(landing=folder, lake=workspace.path("lake"), file_name=name))


def _hours_came_to(lake: Lakehouse) -> DataFrame:
    keys = list(schemas.BATCH_KEYS)
    groups = lake.gold.scan().groupBy(*keys).agg(
        F.count(F.lit(1)).alias("gold_rows"),
        F.sum("user_density_count").alias("gold_samples"),
    )
    reports = lake.reports.scan()
    counts = reports.select(*keys, "total_raw_records", "clean_count", "dirty_count")
    batches = quality.gate(reports).join(counts, keys)
    return batches.join(groups, keys, "left").fillna(0, ["gold_rows", "gold_samples"])


@registered
def ops_backfill_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing files to gold for 24 hours, then what every hour came to."""
    lake = _landed_lake(spark, sf_dir)
    run_range(lake, DAY, cell_info(spark, sf_dir))
    return _hours_came_to(lake)


@registered
def ops_stagewise_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same stage by stage, as an outside scheduler would: the gate holds in each."""
    lake = _landed_lake(spark, sf_dir)
    lake.ingest(DAY)
    lake.check(DAY)
    lake.enrich(DAY, cell_info(spark, sf_dir))
    lake.aggregate(DAY)
    return _hours_came_to(lake)


@registered
def ops_restated_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day run, two of its hours delivered anew, and the day run again: what changed hours came to."""
    lake = _landed_lake(spark, sf_dir)
    cells = cell_info(spark, sf_dir)
    run_changed(lake, DAY, cells)
    _deliver(measurements(spark, sf_dir).where("hour IN ('03', '08') AND event_id % 5 != 0"), lake.settings.landing)
    again = run_changed(lake, DAY, cells)
    idle = [b.hour for b in again.unchanged]
    return _hours_came_to(lake).withColumn("restated", ~F.col("hour").isin(idle))


@registered
def ops_fates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What becomes of hours: one without rows, one whose file cannot be mapped, one without a file, and the others."""
    lake = _landed_lake(spark, sf_dir)
    header = ",".join(f.name for f in schemas.LANDING)
    for hour, text in (("04", header), ("05", "a,b\n1,2")):
        lines = spark.createDataFrame([(text,)], "value string").coalesce(1)
        lines.write.mode("overwrite").text(f"{lake.settings.landing}/slot={DATE}-{hour}")
    outcome = run_range(lake, [*DAY, Batch("2026-05-06", "00")], cell_info(spark, sf_dir))
    fates = ("passed", "blocked", "empty", "missing", "unmappable")
    rows = [(b.date, b.hour, fate) for fate in fates for b in getattr(outcome, fate)]
    return spark.createDataFrame(rows, "date string, hour string, fate string")
