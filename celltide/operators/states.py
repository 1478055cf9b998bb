"""Mergeable states of the indicators: hours add up to days, and cells to hexagons, without measurements.

A state holds the number of samples, how often each signal value occurs, and
the sum and number of distances. Adding these up gives the state of the groups
together, and every indicator follows from it, the tenth percentile too. RSRP
has 97 values in its valid range, so a state stays small however many rows or
states have gone into it; the list is sorted and has only values that occur.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from celltide.operators.kpi import GOLD_KEYS
from celltide.schemas import BATCH_KEYS, RadioDomain, table_schema

_COUNT = T.StructType([T.StructField("value", T.IntegerType()), T.StructField("n", T.LongType())])
STATE = T.StructType(
    [
        *table_schema("h3_index string, cell_id string, samples bigint"),
        T.StructField("signals", T.ArrayType(_COUNT)),
        *table_schema("km_sum double, km_n bigint, cell_lat double, cell_lon double"),
        *table_schema(", ".join(f"{k} string" for k in BATCH_KEYS)),
    ]
)


def _collected(counted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """States from rows of ``keys, value, n, km_sum, km_n`` and site; a row per key and value at most."""
    known = F.collect_list(F.when(F.col("value").isNotNull(), F.struct("value", "n")))  # passes over nulls
    sites = [F.max(c).alias(c) for c in ("cell_lat", "cell_lon") if c in counted.columns]
    return counted.groupBy(*keys).agg(
        F.sum("n").alias("samples"),
        F.sort_array(known).alias("signals"),
        F.coalesce(F.sum("km_sum"), F.lit(0.0)).alias("km_sum"),
        F.sum("km_n").alias("km_n"),
        *sites,
    )


def states(enriched: DataFrame, keys: Sequence[str] = GOLD_KEYS) -> DataFrame:
    """The state of each group of enriched measurements.

    Counted by key and signal value first, within tasks and then across them,
    so a group with a third of all rows sends 98 rows a task at most.
    """
    sites = [F.max(c).alias(c) for c in ("cell_lat", "cell_lon") if c in enriched.columns]
    counted = enriched.groupBy(*keys, F.col("p_cell_rsrp").alias("value")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("distance_to_cell_km").alias("km_sum"),
        F.count("distance_to_cell_km").alias("km_n"),
        *sites,
    )
    return _collected(counted, keys)


def merged(stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """States of coarser groups from states of finer ones."""
    known = _total(lambda s: s["n"])
    # samples without a signal are one more value, null; it also carries the distances, once per state
    unknown = F.struct(F.lit(None).cast("int").alias("value"), (F.col("samples") - known).alias("n"))
    sites = [c for c in ("cell_lat", "cell_lon") if c in stored.columns]
    each = stored.select(*keys, F.explode(F.concat("signals", F.array(unknown))).alias("s"), "km_sum", "km_n", *sites)
    first = F.col("s.value").isNull()
    counted = each.groupBy(*keys, F.col("s.value").alias("value")).agg(
        F.sum("s.n").alias("n"),
        F.sum(F.when(first, F.col("km_sum"))).alias("km_sum"),
        F.coalesce(F.sum(F.when(first, F.col("km_n"))), F.lit(0)).alias("km_n"),
        *[F.max(c).alias(c) for c in sites],
    )
    return _collected(counted, keys)


def _total(of: Callable[[Column], Column]) -> Column:
    """The sum of a value over the signals of a state."""
    return F.aggregate("signals", F.lit(0).cast("bigint"), lambda total, s: total + of(s).cast("bigint"))


def percentile(share: float) -> Column:
    """The smallest signal with at least this share of all known signals at or below it."""
    step = F.struct(F.lit(0).cast("bigint").alias("below"), F.lit(None).cast("int").alias("found"))

    def walk(seen: Column, s: Column) -> Column:
        below = seen["below"] + s["n"]
        reached = seen["found"].isNull() & (below >= F.lit(share) * _total(lambda x: x["n"]))
        return F.struct(below.alias("below"), F.when(reached, s["value"]).otherwise(seen["found"]).alias("found"))

    return F.aggregate("signals", step, walk, lambda seen: seen["found"])


def indicators(stored: DataFrame, domain: RadioDomain = RadioDomain()) -> DataFrame:
    """The five indicators of each state, named and rounded as those of measurements; other columns stay."""
    known = _total(lambda s: s["n"])
    signals = _total(lambda s: s["value"] * s["n"])
    weak = _total(lambda s: F.when(s["value"] < domain.weak_below_rsrp, s["n"]).otherwise(0))
    kept = [c for c in stored.columns if c not in ("samples", "signals", "km_sum", "km_n")]
    return stored.select(
        *kept,
        F.col("samples").alias("user_density_count"),
        F.round(F.try_divide(signals.cast("double"), known.cast("double")), 2).alias("avg_rsrp"),
        percentile(0.1).alias("p10_rsrp"),
        F.round(F.try_divide("km_sum", F.col("km_n").cast("double")), 2).alias("avg_distance_km"),
        F.round(weak.cast("double") / F.col("samples").cast("double"), 4).alias("weak_signal_ratio"),
    )


def extremes(stored: DataFrame) -> DataFrame:
    """Adds the weakest and strongest signal of each state: the ends of its sorted list, null without signals."""
    return stored.withColumns(
        {"weakest_rsrp": F.get("signals", F.lit(0))["value"], "strongest_rsrp": F.try_element_at("signals", F.lit(-1))["value"]}
    )
