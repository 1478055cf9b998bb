"""Compaction of lake tables by a plan made from measured file sizes.

An hour whose number of files lies within its band, or which would not get
fewer, is left alone. In the others files are packed into bins of the target
size, first fit by decreasing size; a file larger than that is dealt into
several. Rows go to the task of their bin, so each bin becomes one file.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from celltide.schemas import Batch
from celltide.sources.lake import LakeTable

TARGET_BYTES = 128 << 20
#: An hour is left alone with up to so many times the files it needs.
BAND = 2.0


@dataclass(frozen=True)
class Bins:
    """What becomes of a partition: its files' bins, as first bin and number of bins, and how many bins there are."""

    files: dict[str, tuple[int, int]]
    n_bins: int


def pack(sizes: dict[str, int], target: int) -> Bins:
    """Files into bins of at most ``target`` bytes, first fit by decreasing size; larger files get bins of their own."""
    bins: dict[str, tuple[int, int]] = {}
    room: list[tuple[int, int]] = []  # bytes left and bin
    n_bins = 0
    for name, size in sorted(sizes.items(), key=lambda f: (-f[1], f[0])):
        if size > target:
            share = math.ceil(size / target)
            bins[name] = (n_bins, share)
            n_bins += share
            continue
        fitting = [i for i, (left, _) in enumerate(room) if left >= size]
        if fitting:
            left, number = room[fitting[0]]
            room[fitting[0]] = (left - size, number)
        else:
            number, n_bins = n_bins, n_bins + 1
            room.append((target - size, number))
        bins[name] = (number, 1)
    return Bins(bins, n_bins)


def plan(table: LakeTable, batches: Sequence[Batch], target: int = TARGET_BYTES, band: float = BAND) -> dict[tuple[str, ...], Bins]:
    """The partitions that are worth rewriting, with their bins; from one listing per day, no data is read."""
    found = {}
    for values, sizes in table.file_sizes(batches).items():
        needed = max(1, math.ceil(sum(sizes.values()) / target))
        too_large = any(size > band * target for size in sizes.values())
        if len(sizes) > band * needed or too_large:
            bins = pack(sizes, target)
            if too_large or bins.n_bins < len(sizes):
                found[values] = bins
    return found


def compact(
    table: LakeTable, batches: Sequence[Batch], target: int = TARGET_BYTES, band: float = BAND
) -> dict[tuple[str, ...], tuple[int, int]]:
    """Rewrite the partitions of a Parquet table that the plan names; their numbers of files before and after.

    All are rewritten by one job. Rows stay as they are; only the layout
    changes. A task holds one bin, whatever the hour. Other formats compact by
    means of their own.
    """
    if table.fmt != "parquet":
        raise ValueError(f"{table.fmt} tables have a compaction of their own")
    planned = plan(table, batches, target, band)
    if not planned:
        return {}
    first, rows, before = 0, [], table.file_sizes(batches)
    for values, bins in sorted(planned.items()):
        rows += [(*values, name, first + at, n) for name, (at, n) in bins.files.items()]
        first += bins.n_bins
    keys = table.partitions
    named = ", ".join(f"{k} string" for k in keys)
    # a row per file of the hours to rewrite: as long as the listing
    files = table.spark.createDataFrame(rows, f"{named}, _file string, _first int, _bins int")
    hours = sorted({Batch(*values[-2:]) for values in planned})
    scan = table.scan(hours).withColumn("_file", F.col("_metadata.file_name"))
    dealt = scan.withColumn("_row", F.monotonically_increasing_id()).join(F.broadcast(files), [*keys, "_file"])
    part = (F.col("_first") + F.pmod(F.col("_row"), F.col("_bins"))).cast("int")
    binned: DataFrame = dealt.withColumn("_bin", part).repartitionById(first, F.col("_bin"))
    table.rewrite(binned.drop("_file", "_first", "_bins", "_row", "_bin"), list(planned))
    after = table.file_sizes(hours)
    return {values: (len(before[values]), len(after.get(values, {}))) for values in planned}
