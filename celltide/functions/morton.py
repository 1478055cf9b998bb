"""Positions along a Morton curve: near places get near keys, so sorted files cover small boxes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from celltide.schemas import BATCH_KEYS, RadioDomain

#: Bits of each coordinate; 16 make steps of 25 m over the valid range.
BITS = 16
# The masks that spread 16 bits apart, each with its shift.
_SPREAD = ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555))


def _step(value: Column, low: float, high: float) -> Column:
    """The step of a coordinate within its range; beyond it the first or last one, for none the first."""
    share = (value - F.lit(low)) / F.lit(high - low) * F.lit(float(1 << BITS))
    inside = F.when(value.isNull() | F.isnan(value), F.lit(0.0)).otherwise(share)
    return F.least(F.greatest(F.floor(inside), F.lit(0)), F.lit((1 << BITS) - 1)).cast("bigint")


def _spread(value: Column) -> Column:
    for shift, mask in _SPREAD:
        value = value.bitwiseOR(F.shiftleft(value, shift)).bitwiseAND(F.lit(mask).cast("bigint"))
    return value


def morton(lat: Column, lng: Column, domain: RadioDomain = RadioDomain()) -> Column:
    """The key of a position: bits of both coordinates in turn. Built-in expressions only."""
    rows, columns = (_spread(_step(v.cast("double"), *limits)) for v, limits in ((lat, domain.lat), (lng, domain.lng)))
    return F.shiftleft(rows, 1).bitwiseOR(columns)


def clustered(df: DataFrame, files: int, domain: RadioDomain = RadioDomain()) -> DataFrame:
    """Rows range-partitioned along the curve within their hour, and sorted so within each task.

    ``files`` is the number of tasks over all hours. A position that many rows
    share is split among tasks by the rows' numbers: apply it to a scan, whose
    rows have the same numbers when a task runs again.
    """
    order = [*BATCH_KEYS, "_key", "_row"]
    keyed = df.withColumns({"_key": morton(F.col("lat"), F.col("lng"), domain), "_row": F.monotonically_increasing_id()})
    return keyed.repartitionByRange(files, *order).sortWithinPartitions(*order).drop("_key", "_row")


def in_box(lat: tuple[float, float], lng: tuple[float, float]) -> Column:
    """Positions within a box, its edges included: plain comparisons, which reach the statistics of files."""
    return F.col("lat").between(*lat) & F.col("lng").between(*lng)
