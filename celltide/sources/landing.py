"""Landing files: one CSV per hour, the hour in its name.

Files of different hours may differ in their headers. Files of one header are
read by one scan, whose columns are mapped by name; a file that cannot be
mapped concerns its own hour only.
"""

from __future__ import annotations

import csv
import logging
import re
from collections import defaultdict
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from celltide.schemas import BATCH, LANDING, Batch
from celltide.sources.workspace import hadoop_path

log = logging.getLogger(__name__)

# Fixed value: the name of an hour's file.
FILE_NAME = "mdt_records_{date}-{hour}.csv"

# Spark compares each file's header with the scan's columns once more, so a file
# that is replaced meanwhile is an error instead of a silent mix-up; a malformed
# or empty value reads as null, and the line of a malformed row, or of one with
# too few or too many fields, is kept.
CSV_OPTIONS = {
    "header": True,
    "enforceSchema": False,
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": "unreadable",
    # else a query of some columns would not see that a row has too few or too many
    "columnPruning": False,
}

# Whole numbers are read as decimals first: exports of nullable integers write -97.0.
CSV_SCHEMA = T.StructType(
    [
        T.StructField(f.name, T.DoubleType()) if f.dataType == T.IntegerType() else f
        for f in LANDING
    ]
    + [T.StructField("unreadable", T.StringType())]
)


def whole_numbers(rows: DataFrame) -> DataFrame:
    """Rows of ``CSV_SCHEMA`` with the landing types: ``-97.0`` is -97.

    A number with a fraction, or beyond the type, becomes null and is told in
    ``unreadable``.
    """
    typed, odd = [], F.col("unreadable")
    for field in LANDING:
        value = F.col(field.name)
        if field.dataType == T.IntegerType():
            whole = F.when(value == F.floor(value), value.try_cast("int"))
            told = F.concat(F.lit(f"{field.name}="), value.cast("string"))
            odd = F.coalesce(odd, F.when(value.isNotNull() & whole.isNull(), told))
            value = whole.alias(field.name)
        typed.append(value)
    added = [c for c in rows.columns if c not in CSV_SCHEMA.names]
    return rows.select(*typed, odd.alias("unreadable"), *added)


def with_batch(df: DataFrame, batch: Batch) -> DataFrame:
    """Constant ``date`` and ``hour`` columns."""
    return df.select("*", F.lit(batch.date).alias("date"), F.lit(batch.hour).alias("hour"))


def file_pattern(name: str = FILE_NAME) -> str:
    """The names of all hours' files, as a path pattern."""
    two = "[0-9][0-9]"
    return name.format(date=f"{two}{two}-{two}-{two}", hour=two)


def batch_of_file(name: str = FILE_NAME, path: Column | None = None) -> tuple[Column, Column]:
    """``date`` and ``hour`` of the file a row was read from, or of ``path``.

    Cut out at fixed places behind the name's leading text: this runs for every
    row, and searching for a pattern would cost as much as parsing the row.
    """
    lead, rest = name.split("{date}")
    gap = rest.split("{hour}")[0]
    if not re.fullmatch(r"[A-Za-z0-9_.=-]+", lead):
        raise ValueError(f"file names need plain leading text: {name!r}")
    tail = F.substring_index(F.col("_metadata.file_path") if path is None else path, lead, -1)
    hour_at = len("YYYY-MM-DD") + len(gap) + 1
    return tail.substr(1, 10).alias("date"), tail.substr(hour_at, 2).alias("hour")


# Without these no row can be accepted, so a file that lacks one is not mapped.
NEEDED = ("p_cell_rsrp", "p_cell_rsrq", "lat", "lng", "date_hour")
# A header longer than this is none.
HEADER_BYTES = 1 << 16
# Files whose headers are read at the same time.
READERS = 16


class UnmappableHeaderError(ValueError):
    """Landing files whose columns cannot be told; ``batches`` has the hours and reasons."""

    def __init__(self, batches: dict[Batch, str]) -> None:
        super().__init__("; ".join(f"{b.key}: {why}" for b, why in sorted(batches.items())))
        self.batches = batches


@dataclass(frozen=True)
class LandingFile:
    """A file as the listing has it; ``modified`` in milliseconds."""

    batch: Batch
    path: str
    length: int
    modified: int


@dataclass
class Layout:
    """Landing files by header, and the hours that have a file which cannot be mapped."""

    files: dict[tuple[str, ...], list[LandingFile]] = field(default_factory=dict)
    unmappable: dict[Batch, str] = field(default_factory=dict)

    def batches(self) -> list[Batch]:
        return sorted({f.batch for files in self.files.values() for f in files})

    def without(self, batches: Iterable[Batch]) -> Layout:
        """The same without some hours."""
        gone = set(batches)
        kept = {h: [f for f in files if f.batch not in gone] for h, files in self.files.items()}
        return Layout(
            {h: files for h, files in kept.items() if files},
            {b: why for b, why in self.unmappable.items() if b not in gone},
        )


def landing_files(
    spark: SparkSession, folder: str, batches: Sequence[Batch], name: str = FILE_NAME
) -> list[LandingFile]:
    """The files of those hours that have arrived: one listing per day.

    An hour may also be a directory of files. Files that begin with a dot or
    an underscore are none.
    """
    wanted = {name.format(date=b.date, hour=b.hour): b for b in batches}
    found = []
    for date in sorted({b.date for b in batches}):
        fs, pattern = hadoop_path(spark, f"{folder}/{file_pattern(name.replace('{date}', date))}")
        for status in fs.globStatus(pattern) or []:
            batch = wanted.get(status.getPath().getName())
            if batch is None:
                continue
            inside = fs.listStatus(status.getPath()) if status.isDirectory() else [status]
            found += [
                LandingFile(batch, s.getPath().toString(), s.getLen(), s.getModificationTime())
                for s in inside
                if s is status or not s.getPath().getName().startswith((".", "_"))
            ]
    return found


def landed(
    spark: SparkSession, folder: str, batches: Sequence[Batch], name: str = FILE_NAME
) -> list[Batch]:
    """Those of the hours whose file has arrived."""
    there = {f.batch for f in landing_files(spark, folder, batches, name)}
    return [b for b in batches if b in there]


def read_headers(spark: SparkSession, paths: Sequence[str]) -> list[tuple[str, ...]]:
    """The names in the first line of each file, none of an empty one. Reads these lines only, some files at a time."""
    if not paths:
        return []
    jvm = spark.sparkContext._jvm
    fs, _ = hadoop_path(spark, paths[0])  # files of one folder have one file system
    # looked up once: each name costs a call
    path_of, bounded = jvm.org.apache.hadoop.fs.Path, jvm.org.apache.commons.io.input.BoundedInputStream
    decoded, buffered = jvm.java.io.InputStreamReader, jvm.java.io.BufferedReader

    def read(path: str) -> tuple[str, ...]:
        stream = fs.open(path_of(path))
        try:
            line = buffered(decoded(bounded(stream, HEADER_BYTES), "UTF-8")).readLine()
        finally:
            stream.close()
        return tuple(next(csv.reader([(line or "").removeprefix("\ufeff")]), ()))

    with ThreadPoolExecutor(READERS) as pool:
        return list(pool.map(read, paths))


def unmappable(header: tuple[str, ...]) -> str | None:
    """Why a file with this header cannot be read by column names; None if it can."""
    names = [_known_name(n) for n in header]
    lacking = [n for n in NEEDED if n not in names]
    repeated = sorted({n for n in names if n in LANDING.names and names.count(n) > 1})
    if lacking:
        return f"no column {', '.join(lacking)}"
    return f"column {', '.join(repeated)} more than once" if repeated else None


def _known_name(name: str) -> str:
    return name.strip().lower()


def layout(spark: SparkSession, files: Sequence[LandingFile]) -> Layout:
    """Files by header. Empty files have no rows and are left out.

    The first line of each file is read by the driver, some files at a time:
    as many small reads as there are files, like the listing before it.
    """
    found, by_header = Layout(), defaultdict(list)
    filled = [f for f in files if f.length]
    headers = read_headers(spark, [f.path for f in filled])
    for file, header in zip(filled, headers, strict=True):
        why = unmappable(header)
        if why:
            found.unmappable[file.batch] = why
        else:
            by_header[header].append(file)
    found.files = dict(by_header)
    return Layout(found.without(found.unmappable).files, found.unmappable)


def _one_header(
    spark: SparkSession, header: tuple[str, ...], files: Sequence[LandingFile], name: str
) -> DataFrame:
    """One scan over files of one header: ``CSV_SCHEMA``, ``extra`` and the hour."""
    types = {f.name: f.dataType for f in CSV_SCHEMA}
    known = {_known_name(n): i for i, n in enumerate(header) if _known_name(n) in LANDING.names}
    corrupt = CSV_OPTIONS["columnNameOfCorruptRecord"]
    # names that Spark can compare with the files'; else columns are named by their place
    plain = {n.lower() for n in header}
    comparable = len(plain) == len(header) and "" not in plain and corrupt not in plain
    fields = [
        T.StructField(n if comparable else f"_c{i}", types.get(_known_name(n), T.StringType()))
        for i, n in enumerate(header)
    ]
    schema = T.StructType([*fields, T.StructField(corrupt, T.StringType())])
    reader = spark.read.schema(schema).options(**CSV_OPTIONS | {"enforceSchema": not comparable})
    rows = reader.csv([f.path for f in files])
    batches = {f.batch for f in files}
    rows = with_batch(rows, *batches) if len(batches) == 1 else rows.select("*", *batch_of_file(name))
    at = [f"_{i}" for i in range(len(header))]
    rows = rows.toDF(*at, corrupt, "date", "hour")
    columns = [
        F.col(at[known[n]]).alias(n) if n in known else F.lit(None).cast(types[n]).alias(n) for n in LANDING.names
    ]
    others = [(n, at[i]) for i, n in enumerate(header) if known.get(_known_name(n)) != i]
    extra = F.lit(None).cast("map<string,string>")
    if others:
        # the last of several columns of one name, as a map has it once
        named = {n.strip(): c for n, c in others}
        extra = F.create_map(*(v for n, c in named.items() for v in (F.lit(n), F.col(c))))
    return rows.select(*columns, corrupt, extra.alias("extra"), "date", "hour")


def read_layout(
    spark: SparkSession, files: Layout, name: str = FILE_NAME, extra: bool = False
) -> DataFrame:
    """The rows of some files: one scan for each header, columns mapped by name.

    Names are compared without case and outer spaces. A column that a file
    lacks is null. Other columns are left out, or, with ``extra``, kept as
    texts in a map of that name.
    """
    for header in files.files:
        others = [n for n in header if _known_name(n) not in LANDING.names]
        if others and not extra:
            log.warning("columns left out: %s", ", ".join(map(repr, others)))
    scans = [_one_header(spark, h, group, name) for h, group in sorted(files.files.items())]
    if not scans:
        kept = T.StructType([T.StructField("extra", T.MapType(T.StringType(), T.StringType()))])
        empty = T.StructType([*CSV_SCHEMA, *kept, *BATCH])
        scans = [spark.createDataFrame([], empty)]
    rows = reduce(DataFrame.unionByName, scans)
    return whole_numbers(rows if extra else rows.drop("extra"))


def read_landing(
    spark: SparkSession, folder: str, batches: Sequence[Batch], name: str = FILE_NAME, extra: bool = False
) -> DataFrame:
    """The files of some hours; a missing or unmappable file is an error.

    The types are declared: inference would read the files twice and let one
    odd hour change a column's type.
    """
    files = landing_files(spark, folder, batches, name)
    missing = sorted(set(batches) - {f.batch for f in files})
    if missing:
        raise FileNotFoundError(f"no landing file of {', '.join(b.key for b in missing)} in {folder}")
    found = layout(spark, files)
    if found.unmappable:
        raise UnmappableHeaderError(found.unmappable)
    return read_layout(spark, found, name, extra)
