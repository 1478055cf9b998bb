"""Command line: run stages for one hour or a range of hours.

    spark-submit ... -m celltide all --date 2026-05-05 --hour 09 \\
        --landing s3a://landing --lake s3a://lake --cells /dim/cell_info

Database login comes from the Spark conf: ``spark.celltide.jdbc.url``, ``.user``,
``.password`` and ``.driver``.
"""

from __future__ import annotations

import argparse
import logging
import sys

from pyspark.sql import DataFrame, SparkSession

from celltide import schemas
from celltide.plans.medallion import Lakehouse, Outcome, Settings, run_changed, run_range
from celltide.schemas import Batch
from celltide.sources import jdbc
from celltide.streaming.catchup import catch_up

log = logging.getLogger(__name__)

STAGES = ("ingest", "check", "enrich", "aggregate", "publish", "map", "all", "changed", "reconcile", "compact", "catch-up")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="celltide", description=__doc__)
    p.add_argument("stage", choices=STAGES)
    p.add_argument("--date", help="YYYY-MM-DD")
    p.add_argument("--hour", help="HH; the whole day when left out")
    p.add_argument("--until", help="last hour of a range, YYYY-MM-DD-HH")
    p.add_argument("--landing", required=True)
    p.add_argument("--lake", required=True)
    p.add_argument("--cells", help="Parquet cell master; the database's table when left out")
    p.add_argument("--format", default="parquet", choices=("parquet", "delta"))
    p.add_argument("--checkpoint", help="folder for catch-up's progress")
    p.add_argument("--out", help="folder for the day's map and audit rows")
    p.add_argument("--file-mb", type=int, default=128, help="size of files that compact writes")
    return p


def batches_of(args: argparse.Namespace) -> list[Batch]:
    if args.date is None:
        raise SystemExit("--date is required")
    if args.until is not None:
        return Batch.range(Batch(args.date, args.hour or "00"), Batch.parse(args.until))
    return [Batch(args.date, args.hour)] if args.hour else Batch.day(args.date)


def database(spark: SparkSession) -> jdbc.Database | None:
    conf = {k: spark.conf.get(f"spark.celltide.jdbc.{k}", None)
            for k in ("url", "user", "password", "driver")}
    return jdbc.Database(**conf) if conf["url"] else None


def cells(spark: SparkSession, args: argparse.Namespace, db: jdbc.Database | None) -> DataFrame:
    if args.cells:
        return spark.read.schema(schemas.CELL_INFO).parquet(args.cells)
    if db is None:
        raise SystemExit("name a cell master: --cells or spark.celltide.jdbc.url")
    return jdbc.read_table(spark, db, jdbc.CELL_TABLE)


def run(spark: SparkSession, args: argparse.Namespace) -> int:
    db = database(spark)
    size = args.file_mb << 20 if args.stage == "compact" else 0
    lake = Lakehouse(spark, Settings(args.landing, args.lake, fmt=args.format, database=db, compact_bytes=size))
    if args.stage == "catch-up":
        if not args.checkpoint:
            raise SystemExit("--checkpoint is required")
        outcomes: list[Outcome] = []
        catch_up(lake, cells(spark, args, db), args.checkpoint, outcomes.append).awaitTermination()
        return 1 if any(o.blocked or o.unmappable for o in outcomes) else 0
    batches = batches_of(args)
    if args.stage == "map":
        if not args.out:
            raise SystemExit("--out is required")
        for name, rows in (("map", lake.map_day(args.date)), ("audit", lake.audit_day(args.date))):
            if rows is not None:
                rows.write.mode("overwrite").parquet(f"{args.out}/{name}/{args.date}")
        return 0
    if args.stage in ("all", "changed"):
        run_hours = run_range if args.stage == "all" else run_changed
        outcome = run_hours(lake, batches, cells(spark, args, db))
        return 1 if outcome.blocked or outcome.missing or outcome.unmappable else 0
    if args.stage == "reconcile":
        unequal = lake.reconcile(batches).where("NOT equal").collect()  # two rows an hour at most
        for r in unequal:
            log.error("%s %s %s: %d rows before, %d after", r.date, r.hour, r.step, r.rows_before, r.rows_after)
        return 1 if unequal else 0
    if args.stage == "compact":
        for name, hours in lake.compact(batches).items():
            log.info("%s: %d hours rewritten", name, hours)
        return 0
    if args.stage == "check":
        return 1 if lake.check(batches).blocked else 0
    if args.stage == "enrich":
        lake.enrich(batches, cells(spark, args, db))
    else:
        {"ingest": lake.ingest, "aggregate": lake.aggregate, "publish": lake.publish}[args.stage](
            batches
        )
    return 1 if args.stage != "ingest" and lake.blocked(batches) else 0


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    logging.basicConfig(level=logging.INFO)
    return run(SparkSession.builder.appName(f"celltide-{args.stage}").getOrCreate(), args)


if __name__ == "__main__":
    sys.exit(main())
