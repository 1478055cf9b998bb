"""Which landing files have been taken: length and time of each, kept beside bronze.

An hour whose files are as recorded is not read again; one with other files,
lengths or times has been delivered anew.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass, field

from celltide.schemas import BATCH, Batch, table_schema
from celltide.sources.landing import LandingFile
from celltide.sources.lake import LakeTable

LEDGER = table_schema("path string, length bigint, modified bigint", BATCH)


@dataclass(frozen=True)
class Changes:
    """Hours by what has become of their files since they were recorded."""

    new: list[Batch] = field(default_factory=list)
    restated: list[Batch] = field(default_factory=list)  # other files or lengths
    touched: list[Batch] = field(default_factory=list)  # the same lengths, another time
    unchanged: list[Batch] = field(default_factory=list)


def _name(path: str) -> str:
    return path.rsplit("/", 1)[-1]


class Ledger:
    """The record, a table with a row per file."""

    def __init__(self, table: LakeTable) -> None:
        self.table = table

    def compare(self, files: Sequence[LandingFile]) -> Changes:
        """The files of a listing against the record of their hours, which is read hour by hour."""
        listed: dict[Batch, dict[str, tuple[int, int]]] = defaultdict(dict)
        for f in files:
            listed[f.batch][_name(f.path)] = (f.length, f.modified)
        recorded: dict[Batch, dict[str, tuple[int, int]]] = defaultdict(dict)
        stored = self.table.scan_if_present(list(listed)) if listed else None
        for r in stored.collect() if stored is not None else []:  # a row per file of the requested hours
            recorded[Batch(r.date, r.hour)][r.path] = (r.length, r.modified)
        found = Changes()
        for batch in sorted(listed):
            now, was = listed[batch], recorded.get(batch)
            if was is None:
                found.new.append(batch)
            elif now == was:
                found.unchanged.append(batch)
            elif {n: length for n, (length, _) in now.items()} == {n: length for n, (length, _) in was.items()}:
                found.touched.append(batch)
            else:
                found.restated.append(batch)
        return found

    def record(self, files: Sequence[LandingFile], batches: Sequence[Batch]) -> None:
        """Keep the files of some hours, once these have been taken; a listed hour without files is forgotten."""
        if not batches:
            return
        kept = [
            (_name(f.path), f.length, f.modified, f.batch.date, f.batch.hour) for f in files if f.batch in set(batches)
        ]
        rows = self.table.spark.createDataFrame(kept, LEDGER)
        self.table.replace(rows.coalesce(1), batches)  # a row per file of the requested hours
