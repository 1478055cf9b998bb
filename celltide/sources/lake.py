"""Lake tables: directories partitioned by ``date`` and ``hour``, replaced hour by hour."""

from __future__ import annotations

import json
import logging
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from celltide.schemas import BATCH_KEYS, Batch, batch_key, in_batches, in_batches_sql
from celltide.sources.workspace import hadoop_path

log = logging.getLogger(__name__)


def delta_enabled(spark: SparkSession) -> bool:
    return "DeltaSparkSessionExtension" in spark.conf.get("spark.sql.extensions", "")


@dataclass(frozen=True)
class LakeTable:
    """A table at a path, with a declared schema.

    Declaring it keeps ``hour`` the text ``'09'`` (partition inference would
    make it a number) and saves a pass over the files. Columns that writes add
    are kept in a file beside the data and read by every later scan. ``leading`` names
    partition columns above date and hour. The format is ``parquet``, or
    ``delta`` in a session that has it.
    """

    spark: SparkSession
    root: str
    schema: T.StructType
    leading: tuple[str, ...] = ()
    fmt: str = "parquet"

    def __post_init__(self) -> None:
        if self.fmt not in ("parquet", "delta"):
            raise ValueError(f"format is 'parquet' or 'delta', not {self.fmt!r}")
        if self.fmt == "delta" and not delta_enabled(self.spark):
            raise ValueError("this session has no Delta extension")

    @property
    def partitions(self) -> tuple[str, ...]:
        return (*self.leading, *BATCH_KEYS)

    def exists(self) -> bool:
        fs, path = hadoop_path(self.spark, self.root)
        return fs.exists(path)

    def stored_schema(self) -> T.StructType:
        """The declared columns, and those that writes have added since."""
        fs, path = hadoop_path(self.spark, self._schema_file)
        if not fs.exists(path):
            return self.schema
        stream = fs.open(path)
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        stored = T.StructType.fromJson(json.loads(text))
        return T.StructType([*self.schema, *[f for f in stored if f.name not in self.schema.names]])

    def scan(self, batches: Iterable[Batch] | None = None) -> DataFrame:
        """The table, or some of its batches.

        For batches only their directories are listed and read, so that an hour
        costs the same however long the table is. Columns that older files lack
        read as null.
        """
        if self.fmt == "delta":
            table = self.spark.read.format("delta").load(self.root)
            return table if batches is None else table.filter(in_batches(batches))
        schema = self.stored_schema()
        reader = self.spark.read.schema(schema)
        if batches is None:
            return reader.parquet(self.root)
        batches = list(batches)
        leaves = [self._leaf(values) for values in sorted(self._files(batches))]
        if leaves:
            table = reader.option("basePath", self.root).parquet(*leaves)
            return table.filter(in_batches(batches))
        if self.exists():
            ordered = [f for f in schema if f.name not in self.partitions]
            keys = [f for f in schema if f.name in self.partitions]
            return self.spark.createDataFrame([], T.StructType([*ordered, *keys]))
        return reader.parquet(self.root)  # fails as reading any missing table does

    def scan_if_present(self, batches: Iterable[Batch] | None = None) -> DataFrame | None:
        """None for a table that was never written; any other failure is raised."""
        if not self.exists():
            log.warning("no table at %s", self.root)
            return None
        return self.scan(batches)

    def replace(self, df: DataFrame, batches: Sequence[Batch], rebalance: bool = False) -> None:
        """Make ``batches`` hold exactly the rows of ``df``; other hours stay.

        Running it again gives the same table. A row outside ``batches`` is an
        error. A requested batch without rows is emptied, not left as it was:
        files that were there before the write and still are after it are no
        longer wanted. Columns that the table lacks are added to its stored
        schema; a changed type is refused before anything is written.
        ``rebalance`` groups rows by batch first, for results of a shuffle whose
        every task would else write a file into every hour.
        """
        stray = F.raise_error(F.concat(F.lit("row outside the batches to replace: "), batch_key()))
        rows = df.filter(F.when(in_batches(batches), F.lit(True)).otherwise(stray.cast("boolean")))
        if rebalance:
            rows = rows.hint("rebalance", *self.partitions)
        if self.fmt == "delta":
            (
                rows.write.format("delta")
                .mode("overwrite")
                .option("replaceWhere", in_batches_sql(batches))
                .option("mergeSchema", "true")
                .partitionBy(*self.partitions)
                .save(self.root)
            )
            return
        self._evolve(df.schema)
        before = self._files(batches)
        (
            rows.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*self.partitions)
            .parquet(self.root)
        )
        after = self._files(batches) if before else {}
        for values, names in before.items():
            if names & after.get(values, set()):
                self._delete(values)

    def rewrite(self, rows: DataFrame, partitions: Sequence[tuple[str, ...]]) -> None:
        """Write partitions of a Parquet table anew from its own rows, as they are dealt into tasks.

        ``rows`` may be read from the table: a partition's files are exchanged
        when all of them have been written.
        """
        wanted = {values[-2:] for values in partitions}
        stray = ~in_batches([Batch(*hour) for hour in wanted])
        told = F.raise_error(F.concat(F.lit("row outside the hours to rewrite: "), batch_key()))
        (
            rows.filter(F.when(stray, told.cast("boolean")).otherwise(F.lit(True)))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*self.partitions)
            .parquet(self.root)
        )

    def file_sizes(self, batches: Sequence[Batch]) -> dict[tuple[str, ...], dict[str, int]]:
        """Bytes of each file, by partition: one listing per day."""
        return {values: dict(files) for values, files in self._listed(batches).items()}

    def remove(self, batches: Sequence[Batch]) -> None:
        """Empty some batches; a table that was never written stays so."""
        if self.fmt == "delta":
            if self.exists():
                self.replace(self.scan(batches).limit(0), batches)
            return
        for values in self._files(batches):
            self._delete(values)

    def _delete(self, values: Sequence[str]) -> None:
        fs, path = hadoop_path(self.spark, self._leaf(values))
        fs.delete(path, True)

    @property
    def _schema_file(self) -> str:
        return f"{self.root.rstrip('/')}/_schema.json"  # readers pass over names with an underscore

    def _evolve(self, written: T.StructType) -> None:
        """Keep the columns of a write beside the table, where they are new."""
        stored = self.stored_schema()
        known = {f.name: f for f in stored}
        for f in written:
            if f.name not in known:
                continue
            # by name: whether nested values may be null is no change
            was, now = known[f.name].dataType.simpleString(), f.dataType.simpleString()
            if was != now:
                raise ValueError(f"column {f.name} of {self.root} is {was} and would become {now}")
        added = [T.StructField(f.name, f.dataType) for f in written if f.name not in known]
        if not added:
            return
        fs, path = hadoop_path(self.spark, self._schema_file)
        stream = fs.create(path, True)
        try:
            stream.write(bytearray(T.StructType([*stored, *added]).json().encode()))
        finally:
            stream.close()

    def _leaf(self, values: Sequence[str]) -> str:
        named = (f"{k}={v}" for k, v in zip(self.partitions, values))
        return "/".join([self.root.rstrip("/"), *named])

    def _files(self, batches: Sequence[Batch]) -> dict[tuple[str, ...], set[str]]:
        """File names by partition on disk, among the requested ones: one listing per day."""
        return {values: set(files) for values, files in self._listed(batches).items()}

    def _listed(self, batches: Sequence[Batch]) -> dict[tuple[str, ...], dict[str, int]]:
        wanted = {(b.date, b.hour) for b in batches}
        found: dict[tuple[str, ...], dict[str, int]] = {}
        upper = "/*" * len(self.leading)
        for date in sorted({b.date for b in batches}):
            fs, pattern = hadoop_path(self.spark, f"{self.root}{upper}/date={date}/hour=*/*")
            for status in fs.globStatus(pattern) or []:
                *_, name = parts = status.getPath().toString().split("/")
                values = tuple(p.split("=", 1)[1] for p in parts[-len(self.partitions) - 1 : -1])
                if values[-2:] in wanted:
                    found.setdefault(values, {})[name] = status.getLen()
        return found
