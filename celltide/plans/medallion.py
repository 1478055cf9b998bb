"""Landing to gold for one hour or a long backfill.

Each stage is one job over all requested hours; none loops over them. Stages
hand over through lake tables, so a run that stops can start again at any
stage, and running a stage twice gives the same tables.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from celltide import schemas
from celltide.functions.grid import Grid, HexGrid
from celltide.functions.morton import clustered, in_box
from celltide.operators import enrich as en
from celltide.operators import kpi, quality, serve, states
from celltide.operators.digest import digests, reconciled
from celltide.schemas import Batch, RadioDomain
from celltide.sources import jdbc, landing
from celltide.sources.compact import compact
from celltide.sources.lake import LakeTable
from celltide.sources.ledger import LEDGER, Ledger
from celltide.sources.workspace import Workspace

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Settings:
    """Where tables live and which limits apply."""

    landing: str
    lake: str
    file_name: str = landing.FILE_NAME
    fmt: str = "parquet"
    domain: RadioDomain = RadioDomain()
    grid: Grid = field(default_factory=HexGrid)
    distance: str = "haversine"
    null_policy: str = "quarantine"
    gate_percent: float = quality.GATE_PERCENT
    database: jdbc.Database | None = None
    connections: int = 8
    #: keep mergeable states of the indicators beside gold
    states: bool = False
    #: count exact repeats of rows in the report's ``repeated_count``
    count_repeats: bool = False
    #: size of files that hours with many small ones are rewritten to; 0 leaves them
    compact_bytes: int = 0
    #: files per hour of the enriched table laid out along the Morton curve; 0 leaves rows as they come
    curve_files: int = 0


@dataclass(frozen=True)
class Outcome:
    """Batches by fate: scored well enough, held back, without any row, or not processed.

    Not processed are those without a file, with one whose columns cannot be
    told, and, where only changes are asked for, those that have not changed.
    """

    passed: list[Batch]
    blocked: list[Batch]
    empty: list[Batch]
    missing: list[Batch] = field(default_factory=list)
    unmappable: list[Batch] = field(default_factory=list)
    unchanged: list[Batch] = field(default_factory=list)


class Lakehouse:
    """The tables of a run and the stages between them."""

    def __init__(self, spark: SparkSession, settings: Settings) -> None:
        self.spark = spark
        self.settings = settings
        self.workspace = Workspace(spark)
        root = settings.lake.rstrip("/")

        def table(name: str, schema, leading: tuple[str, ...] = ()) -> LakeTable:
            return LakeTable(spark, f"{root}/{name}", schema, leading, settings.fmt)

        self.bronze = table("bronze/mdt_raw", schemas.RAW)
        self.checked = table("silver/mdt_checked", schemas.CHECKED, ("verdict",))
        self.reports = table("silver/quality_report", schemas.REPORT)
        self.enriched = table("silver/mdt_enriched", schemas.ENRICHED)
        self.gold = table("gold/mdt_aggregated", schemas.GOLD)
        self.states = table("gold/mdt_states", states.STATE)
        self.ledger = Ledger(table("bronze/landing_files", LEDGER))

    def clean(self, batches: Sequence[Batch] | None = None) -> DataFrame:
        """Accepted rows."""
        return self.checked.scan(batches).filter(F.col("verdict") == "clean").drop("verdict")

    def quarantine(self, batches: Sequence[Batch] | None = None) -> DataFrame:
        """Rejected rows."""
        return self.checked.scan(batches).filter(F.col("verdict") == "dirty").drop("verdict")

    def ingest(self, batches: Sequence[Batch]) -> None:
        """Landing files to bronze, types declared, hour added."""
        s = self.settings
        self.store_raw(landing.read_landing(self.spark, s.landing, batches, s.file_name), batches)

    def store_raw(self, rows: DataFrame, batches: Sequence[Batch]) -> None:
        self.bronze.replace(rows, batches)

    def check(self, batches: Sequence[Batch]) -> Outcome:
        """Score every batch and split its rows; evidence is written before any verdict.

        Two passes over bronze: one aggregate for all rules and counts, one
        write for both branches.
        """
        s = self.settings
        raw = self.bronze.scan_if_present(batches)
        if raw is None:
            return Outcome([], [], list(batches))
        scores = quality.report(raw, domain=s.domain, null_policy=s.null_policy)
        kept = list(schemas.REPORT.names)
        if s.count_repeats:
            counted = quality.repeats(raw).drop("total_rows").withColumnRenamed("repeated_rows", "repeated_count")
            scores, kept = scores.join(counted, list(schemas.BATCH_KEYS)), [*kept, "repeated_count"]
        self.reports.replace(scores.select(*kept), batches, rebalance=True)
        self.checked.replace(
            quality.with_verdict(raw, s.domain, s.null_policy).withColumn(
                "processed_at", F.current_timestamp()
            ),
            batches,
        )
        rows = self.reports.scan(batches).collect()  # one per requested batch
        quality.log_report(rows, s.gate_percent)
        score = {Batch(r.date, r.hour): r.gx_success_rate for r in rows}
        return Outcome(
            passed=[b for b in batches if b in score and score[b] >= s.gate_percent],
            blocked=[b for b in batches if b in score and score[b] < s.gate_percent],
            empty=[b for b in batches if b not in score],
        )

    def blocked(self, batches: Sequence[Batch]) -> list[Batch]:
        """Those of the batches whose stored score is below the gate."""
        reports = self.reports.scan_if_present(batches)
        if reports is None:
            return []
        found = quality.gate(reports, self.settings.gate_percent).filter("blocked").collect()
        below = {(r.date, r.hour) for r in found}  # one row per requested batch
        return [b for b in batches if (b.date, b.hour) in below]

    def _admitted(self, batches: Sequence[Batch]) -> list[Batch]:
        """The batches that may go on; what later stages hold of the others is taken out."""
        blocked = self.blocked(batches)
        if blocked:
            self.withdraw(blocked)
        return [b for b in batches if b not in set(blocked)]

    def withdraw(self, batches: Sequence[Batch]) -> None:
        """Take blocked hours out of the tables behind the gate, should an earlier run have passed them."""
        for b in batches:
            log.error("batch %s is below %.1f%%", b.key, self.settings.gate_percent)
        self.enriched.remove(batches)
        self.gold.remove(batches)
        self.states.remove(batches)

    def enrich(self, batches: Sequence[Batch], cell_info: DataFrame, admitted: bool = False) -> None:
        """Clean rows of the hours above the gate, with grid cell, site and distance.

        ``admitted`` hours are known to be above it, so their reports are not read again.
        """
        s = self.settings
        if not self.checked.exists():
            return
        batches = batches if admitted else self._admitted(batches)
        if not batches:
            return
        # staged once: a database would be read again by every job below
        sites = en.site_lookup(self.workspace.stage(cell_info, "cell_info"))
        clean = self.clean(batches)
        positions = en.cell_positions(clean, sites, self.workspace)
        centre = ("h3_center_lat", "h3_center_lon")
        rows = en.enrich(clean, positions, s.grid, s.distance, centre).select(*schemas.ENRICHED.names)
        if s.curve_files:
            # staged: the layout numbers rows, which a scan does alike when a task runs again
            rows = clustered(self.workspace.stage(rows, "enriched"), s.curve_files * len(batches), s.domain)
        self.enriched.replace(rows, batches, rebalance=not s.curve_files and en.scatters(clean, positions))
        self.workspace.clear()

    def aggregate(self, batches: Sequence[Batch], admitted: bool = False) -> None:
        """Enriched rows of the hours above the gate to gold."""
        if not self.enriched.exists():
            return
        batches = batches if admitted else self._admitted(batches)
        if not batches:
            return
        enriched = self.enriched.scan(batches)
        rows = kpi.gold(enriched, self.settings.grid, self.settings.domain)
        self.gold.replace(rows.select(*schemas.GOLD.names), batches, rebalance=True)

    def summarise(self, batches: Sequence[Batch], admitted: bool = False) -> None:
        """Enriched rows of the hours above the gate to mergeable states, per hexagon and cell."""
        if not self.enriched.exists():
            return
        batches = batches if admitted else self._admitted(batches)
        if batches:
            found = states.states(self.enriched.scan(batches))
            self.states.replace(found.select(*states.STATE.names), batches, rebalance=True)

    def roll_up(self, batches: Sequence[Batch], keys: Sequence[str] = ("date", "h3_index", "cell_id")) -> DataFrame:
        """The indicators of coarser groups, from the stored states of some hours; measurements are not read."""
        return states.indicators(states.merged(self.states.scan(batches), keys), self.settings.domain)

    def reconcile(self, batches: Sequence[Batch]) -> DataFrame:
        """``date, hour, step, rows_before, rows_after, equal``: whether every row has gone on, each as often.

        Bronze against clean and quarantined rows together (with
        ``null_policy="drop"``, bronze without the undecided ones), and clean
        against enriched rows of hours above the gate. One pass over each
        table, without a shuffle of rows.
        """
        s = self.settings
        raw = self.bronze.scan(batches)
        if s.null_policy == "drop":
            raw = raw.filter(quality.acceptance(s.domain).isNotNull())
        columns = [c for c in schemas.RAW.names if c not in schemas.BATCH_KEYS]
        split = reconciled(raw, [self.clean(batches), self.quarantine(batches)], columns)
        found = split.withColumn("step", F.lit("split"))
        admitted = [b for b in batches if b not in set(self.blocked(batches))]
        if admitted and self.enriched.exists():
            columns = [c for c in schemas.LANDING.names]
            onward = reconciled(self.clean(admitted), [self.enriched.scan(admitted)], columns)
            found = found.unionByName(onward.withColumn("step", F.lit("enrich")))
        return found.select(*schemas.BATCH_KEYS, "step", "rows_before", "rows_after", "equal")

    def compact(self, batches: Sequence[Batch]) -> dict[str, int]:
        """Rewrite hours of many small files in the tables written without a shuffle; hours rewritten, by table."""
        target = self.settings.compact_bytes
        tables = {"bronze": self.bronze, "checked": self.checked, "enriched": self.enriched}
        return {n: len(compact(t, batches, target)) for n, t in tables.items() if target and t.exists()}

    def publish(self, batches: Sequence[Batch], admitted: bool = False) -> None:
        """Gold and audit rows to the serving database; hours below the gate have no gold rows."""
        s = self.settings
        if s.database is None:
            raise ValueError("no database in the settings")
        if not admitted:
            self._admitted(batches)
        gold = self.gold.scan_if_present(batches)
        if gold is not None:
            rows = serve.spatial_rows(gold.select(*schemas.GOLD.names), s.grid)
            jdbc.replace_batches(rows, s.database, jdbc.SPATIAL_TABLE, batches, s.connections)
        audit = self.reports.scan_if_present(batches)
        if audit is not None:
            rows = audit.select(*schemas.AUDIT_COLUMNS)
            jdbc.replace_batches(rows, s.database, jdbc.AUDIT_TABLE, batches, 1)

    def map_day(self, date: str) -> DataFrame | None:
        """The day's map rows from the lake; None before the first gold table."""
        gold = self.gold.scan_if_present(Batch.day(date))
        return None if gold is None else serve.map_day(gold, date)

    def box(self, batches: Sequence[Batch], lat: tuple[float, float], lng: tuple[float, float]) -> DataFrame:
        """Enriched rows of some hours within a box; with ``curve_files`` most row groups outside are not read."""
        return self.enriched.scan(batches).filter(in_box(lat, lng))

    def audit_day(self, date: str) -> DataFrame | None:
        report = self.reports.scan_if_present(Batch.day(date))
        return None if report is None else serve.audit_day(report, date)


def run_range(lake: Lakehouse, batches: Sequence[Batch], cell_info: DataFrame) -> Outcome:
    """Every stage over all batches.

    One bad hour does not hold up the others: blocked hours stop after the
    quality stage, hours without a landing file, or with one whose columns
    cannot be told, are left as they are.
    """
    s = lake.settings
    return _run_files(lake, landing.landing_files(lake.spark, s.landing, batches, s.file_name), batches, cell_info)


def run_changed(lake: Lakehouse, batches: Sequence[Batch], cell_info: DataFrame) -> Outcome:
    """Every stage over those batches whose landing files are new or were delivered again.

    Files are known by length and time, so an hour as recorded costs its place
    in the listing only. One whose files have another time but their old
    length is read once and processed only if its rows differ from bronze.
    """
    s = lake.settings
    files = landing.landing_files(lake.spark, s.landing, batches, s.file_name)
    changes = lake.ledger.compare(files)
    same = _same_rows(lake, [f for f in files if f.batch in set(changes.touched)])
    lake.ledger.record(files, same)
    idle = sorted({*changes.unchanged, *same})
    outcome = _run_files(
        lake, [f for f in files if f.batch not in set(idle)], [b for b in batches if b not in set(idle)], cell_info
    )
    return replace(outcome, unchanged=idle)


def _same_rows(lake: Lakehouse, files: Sequence[landing.LandingFile]) -> list[Batch]:
    """Those hours whose files hold the rows that bronze has of them, by digest."""
    found = landing.layout(lake.spark, files)
    batches = found.batches()
    stored = lake.bronze.scan_if_present(batches) if batches else None
    if stored is None:
        return []
    columns = [c for c in schemas.RAW.names if c not in schemas.BATCH_KEYS]
    delivered = digests(landing.read_layout(lake.spark, found, lake.settings.file_name), columns, name="delivered")
    equal = delivered.join(digests(stored, columns), list(schemas.BATCH_KEYS)).where("delivered = digest").collect()
    same = {(r.date, r.hour) for r in equal}  # a row per touched hour
    return [b for b in batches if (b.date, b.hour) in same]


def _run_files(
    lake: Lakehouse, files: Sequence[landing.LandingFile], batches: Sequence[Batch], cell_info: DataFrame
) -> Outcome:
    """Every stage over the hours of some listed files, which are recorded once they are through."""
    arrived = {f.batch for f in files}
    missing = [b for b in batches if b not in arrived]
    for b in missing:
        log.error("batch %s has no landing file", b.key)
    found = landing.layout(lake.spark, files)
    for b, why in sorted(found.unmappable.items()):
        log.error("batch %s is left as it is: %s", b.key, why)
    unmappable = sorted(found.unmappable)
    taken = [b for b in batches if b in arrived and b not in found.unmappable]
    if not taken:
        return Outcome([], [], [], missing, unmappable)
    lake.store_raw(landing.read_layout(lake.spark, found, lake.settings.file_name), taken)
    outcome = run_stored(lake, taken, cell_info)
    lake.ledger.record(files, taken)
    return replace(outcome, missing=missing, unmappable=unmappable)


def run_stored(lake: Lakehouse, batches: Sequence[Batch], cell_info: DataFrame) -> Outcome:
    """The stages behind ingest, for batches that are in bronze.

    A blocked hour stops after the quality stage, and leaves the tables behind
    it if an earlier run had passed it. An hour that has become empty goes on,
    to be emptied in every table.
    """
    outcome = lake.check(batches)
    if outcome.blocked:
        lake.withdraw(outcome.blocked)
    onward = [b for b in batches if b not in set(outcome.blocked)]
    if onward:
        lake.enrich(onward, cell_info, admitted=True)
        lake.aggregate(onward, admitted=True)
        if lake.settings.states:
            lake.summarise(onward, admitted=True)
    if lake.settings.compact_bytes:
        lake.compact(batches)
    if lake.settings.database is not None:
        lake.publish(batches, admitted=True)
    return outcome


def run_batch(lake: Lakehouse, batch: Batch, cell_info: DataFrame) -> Outcome:
    """One hour; a blocked one raises once its evidence is stored, a missing one at once."""
    outcome = run_range(lake, [batch], cell_info)
    if outcome.missing:
        raise FileNotFoundError(f"batch {batch.key} has no landing file")
    if outcome.unmappable:
        raise landing.UnmappableHeaderError({batch: "its columns cannot be told"})
    if outcome.blocked:
        raise quality.QualityGateError(
            f"batch {batch.key} is below {lake.settings.gate_percent:.1f}%"
        )
    return outcome
