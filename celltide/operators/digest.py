"""Order-free digests of rows, to tell whether tables hold the same rows without comparing them.

A row is hashed to 130 bits, and a digest is the number of rows and the sums
of the five parts of their hashes. Sums do not depend on order or files, count
repeated rows, and add up: the digest of two tables together is the sum of
theirs. What is shuffled is one row per task and hour, never a measurement.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from celltide.schemas import BATCH_KEYS

#: Sums of 26 bits stay below 2 ** 63 up to 2 ** 37 rows of an hour.
PART_BITS, PARTS = 26, 5
DIGEST = "array<bigint>"


def _parts(columns: Sequence[str]) -> list[Column]:
    """Five numbers of 26 bits per row. Nulls are told apart by a text of marks, as hashes pass over them."""
    marks = F.concat(*[F.when(F.col(c).isNull(), "0").otherwise("1") for c in columns])
    mask = F.lit((1 << PART_BITS) - 1)
    hashes = [F.xxhash64(F.lit(seed), marks, *[F.col(c) for c in columns]) for seed in range(1, 4)]
    halves = [F.shiftrightunsigned(h, s).bitwiseAND(mask) for h in hashes for s in (0, 32)]
    return halves[:PARTS]


def row_digest(columns: Sequence[str], only: Column | None = None) -> Column:
    """Aggregate: the digest of a group's rows over some columns, or of those for which ``only`` holds."""
    taken = F.lit(True) if only is None else F.coalesce(only, F.lit(False))
    sums = [F.coalesce(F.sum(F.when(taken, part)), F.lit(0).cast("bigint")) for part in _parts(columns)]
    return F.array(F.count_if(taken), *sums)


def added(left: Column, right: Column) -> Column:
    """The digest of two tables together; null stands for a table without rows."""
    none = F.array(*[F.lit(0).cast("bigint")] * (PARTS + 1))
    return F.zip_with(F.coalesce(left, none), F.coalesce(right, none), lambda a, b: a + b)


def digests(
    df: DataFrame, columns: Sequence[str], keys: Sequence[str] = BATCH_KEYS, name: str = "digest"
) -> DataFrame:
    """``keys`` and the digest of each group's rows over ``columns``; one pass."""
    return df.groupBy(*keys).agg(row_digest(columns).alias(name))


def reconciled(
    whole: DataFrame, parts: Sequence[DataFrame], columns: Sequence[str], keys: Sequence[str] = BATCH_KEYS
) -> DataFrame:
    """Whether the parts together hold the rows of the whole, each as often: per group both row counts and ``equal``.

    A group that only one side has is told like others, with 0 rows on the other side.
    """
    sides = [digests(whole, columns, keys).withColumn("_side", F.lit(0))]
    sides += [digests(part, columns, keys).withColumn("_side", F.lit(1)) for part in parts]
    together = sides[0]
    for side in sides[1:]:
        together = together.unionByName(side)
    none = F.array(*[F.lit(0).cast("bigint")] * (PARTS + 1))
    sums = [F.sum(F.when(F.col("_side") == s, F.col("digest")[i]).otherwise(F.lit(0))) for s in (0, 1) for i in range(PARTS + 1)]
    found = together.groupBy(*keys).agg(F.array(*sums[: PARTS + 1]).alias("a"), F.array(*sums[PARTS + 1 :]).alias("b"))
    return found.select(
        *keys,
        F.col("a")[0].alias("rows_before"),
        F.col("b")[0].alias("rows_after"),
        (F.coalesce("a", none) == F.coalesce("b", none)).alias("equal"),
    )
