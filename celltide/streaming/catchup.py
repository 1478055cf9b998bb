"""Catch up with landing files through Structured Streaming.

Stands in for an hourly schedule with catch-up: the stream's checkpoint knows
which files were done, each trigger takes the new ones, and every stage
replaces whole hours, so a trigger that is run again changes nothing. The
stream carries the names of files, not their rows: the hours follow from the
names, and each file is read once, by the run of its hour.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from celltide.plans.medallion import Lakehouse, Outcome, run_range
from celltide.schemas import Batch
from celltide.sources.landing import batch_of_file, file_pattern

_FILES = "path string, modificationTime timestamp, length bigint, content binary"


def catch_up(
    lake: Lakehouse,
    cell_info: DataFrame,
    checkpoint: str,
    told: Callable[[Outcome], None] = lambda outcome: None,
) -> StreamingQuery:
    """Process every landing file not seen before, then stop; ``told`` gets each trigger's outcome.

    The stream knows a file by its path. A correction under an old name is
    found by ``run_changed`` over its hours.
    """
    name = lake.settings.file_name
    files = lake.spark.readStream.format("binaryFile").schema(_FILES)
    # a column that is not asked for is not read: no content
    named = files.load(f"{lake.settings.landing}/{file_pattern(name)}").select(*batch_of_file(name, F.col("path")))

    def run(arrived: DataFrame, _: int) -> None:
        hours = arrived.distinct().collect()  # one row per new file
        batches = sorted(Batch(h.date, h.hour) for h in hours)
        if batches:
            told(run_range(lake, batches, cell_info))

    return (
        named.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
