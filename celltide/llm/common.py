"""Helpers shared by the operators: tables, scratch space, hashes, let-bindings, salted joins."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the contracts: space and the controls from tab to carriage return.
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def without(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop input columns that an operator is about to add (names as Spark resolves them)."""
    taken = {n.lower() for n in names}
    return df.drop(*[c for c in df.columns if c.lower() in taken])


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is worked out once.

    Inside a lambda an outer expression would be worked out again for every
    element; a lambda variable is not.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def as_key(key: Column) -> Column:
    """A record key as text; null has a text of its own, so it behaves as one more key."""
    return F.coalesce(key.cast("string"), F.lit("null"))


def unit(*parts: Column) -> Column:
    """A number in (0, 1) from the md5 of the parts, the same in any SQL engine.

    52 bits and a half, so it is never 0 or 1 and always exact.
    """
    digits = F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def salted_join(
    large: DataFrame, side: DataFrame, key: str, spread_by: Column, salts: int = 16
) -> DataFrame:
    """Inner join in which a key holding a large share of ``large`` meets in ``salts`` tasks.

    ``side`` has one row per key and is copied ``salts`` times; ``spread_by``
    is a value that differs between the rows of a key.
    """
    copies = side.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = large.withColumn("_salt", F.pmod(F.hash(spread_by), F.lit(salts)))
    return salted.join(copies, [key, "_salt"]).drop("_salt")
