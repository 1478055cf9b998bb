"""Mixing sources to target weights by Poisson replication.

A source that should be seen r times on average gives each document a number
of copies drawn from a Poisson distribution with mean r, by inverting its
distribution function at a hash of the document. The copies are shuffled
globally by a second hash. The same seed gives the same mixture anywhere.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from celltide.llm.common import as_key, let, table, unit, without
from celltide.operators.joins import Lookup, left_lookup
from celltide.sources.workspace import Workspace

SEED = "mix-1"


def first_step(rate: Column) -> Column:
    """The number of copies below which a draw falls with a chance below double precision; 0 for small rates."""
    return F.greatest(F.floor(rate - 12 * F.sqrt(rate) - 30), F.lit(0)).cast("int")


def _log_factorial(n: Column) -> Column:
    """ln(n!) by Stirling's series, which has double precision where it is asked for: from 30 on, or at 0."""
    x = n.cast("double")
    series = x * F.log(x) - x + F.log(F.lit(2 * math.pi) * x) / 2 + 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5)
    return F.when(n == 0, F.lit(0.0)).otherwise(series)


def poisson_steps(rate: Column, first: Column | None = None) -> Column:
    """The distribution function at ``first`` (0), and on, until the rest is below double precision.

    Terms are built in logarithms, so a large rate does not underflow to all
    zeros. Begun at ``first_step`` the list is as long as 24 times the root of
    the rate, and what lies below it is less than a double can tell.
    """
    first = F.lit(0) if first is None else first
    last = F.ceil(rate + 12 * F.sqrt(rate) + 30).cast("int")
    start = F.struct(F.lit(0.0).alias("term"), F.lit(0.0).alias("total"), F.array().cast("array<double>").alias("steps"))
    at_first = F.when(first == 0, -rate).otherwise(first * F.log(rate) - rate - _log_factorial(first))

    def step(state: Column, k: Column) -> Column:
        term = F.when(k == first, at_first).otherwise(state["term"] + F.log(rate / k))
        return let(
            term,
            lambda t: F.struct(
                t.alias("term"),
                (state["total"] + F.exp(t)).alias("total"),
                F.array_append(state["steps"], state["total"] + F.exp(t)).alias("steps"),
            ),
        )

    steps = F.aggregate(F.sequence(first, last), start, step, lambda state: state["steps"])
    return F.when(rate > 0, steps).otherwise(F.array(F.lit(1.0)))


def rates(
    docs: DataFrame,
    workspace: Workspace,
    weights: Mapping[str, float] | None = None,
    epochs: float = 1.0,
    source: str = "source",
) -> DataFrame:
    """Mean number of repetitions per source: ``source, rate``.

    A source's share of the mixture's bytes is its weight over the weights of
    all sources present; the mixture is ``epochs`` times the bytes of all
    weighted sources. Without ``weights`` all sources weigh the same. Sources
    without a weight, or without bytes, have rate 0. A null source is a source
    of its own and takes the weight under the key ``None``.
    """
    size = F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).cast("double")
    sizes = workspace.stage(docs.groupBy(F.col(source).alias("source")).agg(size.alias("size")), "sizes")
    if weights is None:
        weight = F.lit(1.0)
    else:
        if any(not w >= 0 for w in weights.values()):
            raise ValueError("weights must not be negative")
        weight = F.lit(0.0)
        for name, w in weights.items():
            weight = F.when(F.col("source").eqNullSafe(F.lit(name)), float(w)).otherwise(weight)
    weighted = sizes.withColumn("weight", F.when(F.col("size") > 0, weight).otherwise(0.0))
    used = F.when(F.col("weight") > 0, F.col("size")).otherwise(0.0)
    total, shares = weighted.agg(F.sum(used), F.sum("weight")).first()
    rate = F.lit(epochs * (total or 0.0)) * F.col("weight") / F.lit(shares or 1.0) / F.col("size")
    return weighted.select("source", F.when(F.col("weight") > 0, rate).otherwise(0.0).alias("rate"))


def mix(
    docs: DataFrame,
    weights: Mapping[str, float] | None = None,
    epochs: float = 1.0,
    key: str = "doc_id",
    source: str = "source",
    seed: str = SEED,
) -> DataFrame:
    """Every document as often as drawn, with ``rate``, ``copy`` (from 1) and ``mix_order``.

    Rows come globally shuffled: spread over partitions by ``mix_order``, a
    hash of seed, key and copy, and sorted by it within. Draws depend on seed
    and key alone: rows with one key (or without key) get the same number of
    copies. Null and empty texts weigh nothing and are drawn like any others
    of their source. Columns of the input named like added ones are replaced.
    An empty table gives an empty mixture.

    The lookup of rates is broadcast if its counted bytes are below the
    session's threshold, and salted otherwise, as sources may be many.
    """
    workspace = Workspace(docs.sparkSession)
    steps = workspace.stage(
        rates(docs, workspace, weights, epochs, source).select(
            F.col("source").alias("_source"),
            "rate",
            first_step(F.col("rate")).alias("_first"),
            poisson_steps(F.col("rate"), first_step(F.col("rate"))).alias("_steps"),
        ),
        "rates",
    )
    width = F.coalesce(F.octet_length("_source"), F.lit(0)) + 8 * F.size("_steps") + 96
    size = steps.agg(F.sum(width)).first()[0]
    clean = without(docs, ["rate", "copy", "mix_order", "_source", "_first", "_steps", "_salt"])
    drawn = left_lookup(
        clean.withColumn("_source", F.col(source)), Lookup(steps, ("_source",), size or 0), null_safe=True
    )
    draw = unit(F.lit(seed), F.lit("copies"), as_key(F.col(key)))
    copies = let(draw, lambda u: F.col("_first") + F.size(F.filter(F.col("_steps"), lambda s: s <= u)))
    order = unit(F.lit(seed), F.lit("order"), as_key(F.col(key)), F.col("copy").cast("string"))
    return (
        drawn.withColumn("_copies", copies)
        .where("_copies > 0")
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
        .withColumn("mix_order", order)
        .drop("_source", "_first", "_steps", "_copies")
        .repartition("mix_order")
        .sortWithinPartitions("mix_order")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed so that every source gets the same share of bytes, texts included."""
    return mix(table(spark, sf_dir, "documents"))


ORACLE = """
WITH sizes AS (SELECT source, sum(strlen(coalesce(text, '')))::DOUBLE AS size FROM documents GROUP BY source),
rates AS (
  SELECT source, CASE WHEN size > 0 THEN sum(size) OVER () * 1e0 / count(*) FILTER (size > 0) OVER () / size
    ELSE 0e0 END AS rate FROM sizes),
terms AS (
  SELECT source, rate, k, CASE WHEN rate > 0 THEN exp(k * ln(rate) - rate - lgamma(k + 1)) ELSE 1e0 END AS p
  FROM (SELECT source, rate,
      unnest(range(0, CASE WHEN rate > 0 THEN ceil(rate + 12 * sqrt(rate) + 31)::BIGINT ELSE 1 END)) AS k
    FROM rates)),
steps AS (SELECT source, rate, sum(p) OVER (PARTITION BY source ORDER BY k) AS s FROM terms),
draws AS (
  SELECT *, (('0x' || substr(md5('mix-1:copies:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT + 0.5e0)
    / 4503599627370496e0 AS u FROM documents),
counted AS (
  SELECT d.doc_id, any_value(s.rate) AS rate, count(*) FILTER (s.s <= d.u) AS copies
  FROM draws d JOIN steps s ON d.source IS NOT DISTINCT FROM s.source GROUP BY d.doc_id),
copied AS (SELECT doc_id, rate, unnest(range(1, copies + 1))::INT AS copy FROM counted)
SELECT d.*, c.rate, c.copy,
  (('0x' || substr(md5('mix-1:order:' || coalesce(doc_id::VARCHAR, 'null') || ':' || c.copy), 1, 13))::BIGINT + 0.5e0)
    / 4503599627370496e0 AS mix_order
FROM copied c JOIN documents d USING (doc_id)
"""
