"""Connected components of a distributed edge list by alternating stars.

Every node hangs itself under the smallest neighbour it knows, in turn from
above and from below, until nothing changes; the number of rounds grows with
the logarithm of the longest path. Each round is written to the shared folder,
which cuts the lineage. Nothing but three totals comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from celltide.sources.workspace import Workspace

MAX_ROUNDS = 60
SALTS = 16
#: A key is hot with this part of all rows and at least so many, so there are a thousand hot keys at most.
HOT_PART, HOT_ROWS = 1000, 100


def spread_join(
    rows: DataFrame, side: DataFrame, counts: DataFrame, key: str, spread_by: Column, total: int, how: str = "inner"
) -> DataFrame:
    """``rows`` joined with ``side``, which has a row per key at most; hot keys meet in ``SALTS`` tasks.

    ``counts`` tells with how many of the ``total`` rows a key is there, as
    ``n``. Only hot keys of the side are copied.
    """
    hot = counts.where((F.col("n") * HOT_PART >= total) & (F.col("n") >= HOT_ROWS)).select(key, F.lit(True).alias("_hot"))
    every = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    copies = side.join(F.broadcast(hot), key, "left").withColumn("_salt", F.explode(every)).drop("_hot")
    salt = F.when(F.col("_hot"), F.pmod(F.hash(spread_by), F.lit(SALTS))).otherwise(F.lit(0))
    salted = rows.join(F.broadcast(hot), key, "left").withColumn("_salt", salt).drop("_hot")
    return salted.join(copies, [key, "_salt"], how).drop("_salt")


def _totals(links: DataFrame) -> tuple:
    seen = F.xxhash64("u", "v")
    return tuple(
        links.agg(F.count(F.lit(1)), F.bit_xor(seen), F.sum(F.pmod(seen, F.lit(1_000_003)))).first()
    )


def _smallest(links: DataFrame) -> DataFrame:
    return links.groupBy("u").agg(F.min("v").alias("low"), F.count(F.lit(1)).alias("n"))


def _with_smallest(links: DataFrame, low_of: DataFrame, total: int) -> DataFrame:
    return spread_join(links, low_of.drop("n"), low_of, "u", F.col("v"), total)


def components(edges: DataFrame, workspace: Workspace) -> DataFrame:
    """``node, component`` for every node with an edge to another; component is its smallest node.

    ``edges`` has two bigint columns ``a`` and ``b``, in any order, repeated or
    not; loops and nulls are ignored. No edges give no rows. A node with a
    large share of all edges is spread over several tasks.
    """
    high, low = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    links = edges.where("a != b").select(high, low).distinct()
    links = workspace.stage(links, "links")
    before = _totals(links)
    for _ in range(MAX_ROUNDS):
        if not before[0]:
            break
        # from above: larger neighbours of u go to the smallest of u and its neighbours
        both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low_of = _smallest(both).withColumn("low", F.least("u", "low"))
        upper = _with_smallest(both.where("v > u"), low_of, before[0])
        upper = upper.select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        # from below: u and its smaller neighbours go to the smallest of them
        low_of = _smallest(upper)
        lower = _with_smallest(upper, low_of, before[0]).where("v != low")
        links = low_of.select("u", F.col("low").alias("v")).unionAll(
            lower.select(F.col("v").alias("u"), F.col("low").alias("v"))
        )
        links = workspace.stage(links.distinct(), "links")
        after = _totals(links)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    roots = links.select(F.col("v").alias("node")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        roots.select("node", F.col("node").alias("component"))
    )
