"""Left lookups of measurements against a keyed side of any size.

A side is broadcast only after it has been measured. Beyond the limit the
lookup shuffles with a salted key, so that a key holding a large share of all
measurements (or the null key) is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from celltide.sources.workspace import Workspace

# Per row of a hashed relation: pointers, null bits and length words.
_ROW_OVERHEAD_BYTES = 48
SALTS = 32
# A key is hot if it has at least this part of all rows.
HOT_SHARE = 200


class DuplicateKeyError(ValueError):
    """A lookup side repeats a key, which would multiply measurements."""


@dataclass(frozen=True)
class Lookup:
    """A keyed side with its measured footprint."""

    df: DataFrame
    keys: tuple[str, ...]
    bytes: int

    def fits(self, limit: int) -> bool:
        return 0 <= self.bytes <= limit


def _width(df: DataFrame) -> Column:
    """Bytes a row takes in a hashed relation, at most."""
    fixed = _ROW_OVERHEAD_BYTES
    texts = []
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            texts.append(F.coalesce(F.octet_length(F.col(field.name)), F.lit(0)))
        else:
            fixed += 8
    return sum(texts, F.lit(fixed)).cast("bigint")


def unique_lookup(df: DataFrame, key: str) -> Lookup:
    """Measure a side that must have one row per key; one small job."""
    per_key = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), F.sum(_width(df)).alias("b")
    )
    repeated = F.count_if(F.col(key).isNotNull() & (F.col("n") > 1))
    size, repeats = per_key.agg(F.sum("b"), repeated).first()
    if repeats:
        raise DuplicateKeyError(f"{repeats} values of {key} occur more than once")
    return Lookup(df, (key,), size or 0)


def staged_lookup(
    df: DataFrame, keys: Sequence[str], workspace: Workspace, name: str
) -> Lookup:
    """Write a computed side once, and measure what was written.

    A plain aggregate over the small copy is exact whatever was lost or run
    again on the way there; metrics collected during the write are not.
    """
    staged = workspace.stage(df, name)
    size = staged.agg(F.sum(_width(staged))).first()[0]
    return Lookup(staged, tuple(keys), size or 0)


def broadcast_limit(df: DataFrame) -> int:
    """The session's own broadcast threshold in bytes; -1 when switched off."""
    text = str(df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold")).strip().lower()
    units = {"k": 10, "m": 20, "g": 30, "t": 40}
    digits = text.rstrip("bkmgt")
    unit = text[len(digits) :].rstrip("b")
    return int(digits) << units[unit] if unit else int(digits)


def with_salt(df: DataFrame, salts: int = SALTS) -> DataFrame:
    """Spread the rows of each key over ``salts`` values.

    Apply to a scan. The row number restarts in every task and follows the
    scan's order, so a task that is run again salts its rows as before. A hash
    of the content would not do: copies of one row would share a salt. Where a
    salted share is still large, adaptive execution splits it as a skewed join.
    """
    return df.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)))


def _hot_keys(side: Lookup, weight: str) -> DataFrame:
    """Keys holding at least one ``HOT_SHARE``-th of all rows: never more than ``HOT_SHARE`` of them."""
    total = side.df.agg(F.sum(weight)).first()[0] or 0
    return side.df.where(F.col(weight) * HOT_SHARE >= total).select(*side.keys)


def left_lookup(
    left: DataFrame,
    side: Lookup,
    null_safe: bool = False,
    salts: int = SALTS,
    weight: str | None = None,
) -> DataFrame:
    """Add the side's other columns to every row of ``left``; no match gives nulls.

    ``weight`` names a column of the side with the number of rows of ``left``
    that each key has; it is not added. Only keys with a large share of all
    rows are then salted and copied, instead of all.
    """
    on_side = {k: f"_side_{k}" for k in side.keys}
    right = side.df.withColumnsRenamed(on_side)
    matches = [
        F.col(k).eqNullSafe(F.col(s)) if null_safe else F.col(k) == F.col(s)
        for k, s in on_side.items()
    ]
    dropped = [*on_side.values(), *([weight] if weight else [])]
    if side.fits(broadcast_limit(left)):
        return left.join(F.broadcast(right), matches, "left").drop(*dropped)
    salted = with_salt(left, salts)
    every_salt = F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))
    if weight:
        hot = _hot_keys(side, weight).withColumnsRenamed({k: f"_hot_{k}" for k in side.keys})
        hot = F.broadcast(hot.withColumn("_hot", F.lit(True)))  # HOT_SHARE rows at most
        names = [f"_hot_{k}" for k in side.keys]
        is_hot = F.coalesce("_hot", F.lit(False))

        def marked(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
            same = [F.col(k).eqNullSafe(F.col(h)) for k, h in zip(keys, names)]
            return rows.join(hot, same, "left").drop(*names)

        salted = marked(salted, side.keys).withColumn(
            "_salt", F.when(is_hot, F.col("_salt")).otherwise(F.lit(0))
        ).drop("_hot")
        right = marked(right, list(on_side.values()))
        no_salt = F.array(F.lit(0).cast("bigint"))
        every_salt = F.when(is_hot, every_salt).otherwise(no_salt)
    copies = right.withColumn("_side_salt", F.explode(every_salt)).drop("_hot").hint("merge")
    matches.append(F.col("_salt") == F.col("_side_salt"))
    return salted.join(copies, matches, "left").drop("_salt", "_side_salt", *dropped)
