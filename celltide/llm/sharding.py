"""Rendezvous hashing of record keys over weighted shards.

Every shard draws a number from the key; the shard with the best draw, scaled
by its weight, takes the record. A new shard can only win records for itself,
so nothing moves between old shards. Slots within a shard are numbered in
parts, by the order of a hash of the key, so no task sees a whole shard.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from celltide.llm.common import as_key, table, unit, without
from celltide.sources.workspace import Workspace

SHARDS = 40
ROWS_PER_PART = 5_000
_SALTS = 64


def rendezvous(key: Column, weights: Sequence[float], first: int = 0) -> Column:
    """The best ``struct(cost, shard)`` of a key among the shards ``first ..``; lower cost wins.

    ``-ln(u) / weight`` is an exponential draw whose minimum falls on a shard
    in proportion to its weight. Ties go to the lower shard.
    """
    if not weights or any(not w > 0 or math.isinf(w) for w in weights):
        raise ValueError("every shard needs a positive finite weight")
    weight = F.array(*[F.lit(float(w)) for w in weights])
    last = first + len(weights) - 1

    def draw(shard: Column) -> Column:
        cost = -F.log(unit(as_key(key), shard.cast("string"))) / F.get(weight, shard - first)
        return F.struct(cost.alias("cost"), shard.alias("shard"))

    return F.array_min(F.transform(F.sequence(F.lit(first), F.lit(last)), draw))


def place(
    docs: DataFrame,
    key: str = "doc_id",
    weights: Sequence[float] = (1.0,) * SHARDS,
    new_weight: float = 1.0,
    tie: str = "text",
    rows_per_part: int = ROWS_PER_PART,
) -> DataFrame:
    """All rows and columns, with ``shard``, ``slot`` and ``grown_shard``.

    ``slot`` counts from 0 without gaps within a shard, by the hash of the key,
    then the key, then ``md5(tie)``. ``grown_shard`` is the shard with one
    more shard of ``new_weight``. Equal keys go to one shard; a null key is one
    more key. Null and empty texts only matter as ties. Columns of the input
    named like one that is added are replaced. An empty table stays empty.
    Parts that repeated keys make too large are split by row number; their
    equal rows then take slots in the order of the written copy.
    """
    spark = docs.sparkSession
    best, new = rendezvous(F.col(key), weights), rendezvous(F.col(key), [new_weight], len(weights))
    parts = max(1, math.ceil(docs.count() / (len(weights) * rows_per_part)))
    tagged = (
        without(docs, ["shard", "slot", "grown_shard", "_best", "_order", "_part", "_salt", "_below"])
        .withColumn("_best", best)
        .withColumns({"_order": unit(as_key(F.col(key)), F.lit("slot")), "shard": F.col("_best.shard")})
        .withColumn("grown_shard", F.when(new < F.col("_best"), len(weights)).otherwise(F.col("shard")))
        .withColumns({"_part": F.floor(F.col("_order") * parts).cast("int"), "_salt": F.lit(0).cast("bigint")})
        .drop("_best")
    )
    workspace = Workspace(spark)
    place_keys = ["shard", "_part", "_salt"]

    def sizes(rows: DataFrame) -> DataFrame:
        return workspace.stage(rows.groupBy(*place_keys).agg(F.count(F.lit(1)).alias("n")), "parts")

    counts = sizes(tagged)
    limit = 8 * rows_per_part
    hot = counts.where(F.col("n") > limit).select("shard", "_part", F.lit(True).alias("_hot"))
    if not hot.isEmpty():  # repeated keys; the written copy fixes the row numbers
        row = F.pmod(F.monotonically_increasing_id(), F.lit(_SALTS))
        salted = workspace.stage(tagged.withColumn("_salt", row), "rows")
        mixed = F.coalesce(F.col("_hot"), F.lit(False))
        tagged = (
            salted.join(hot, ["shard", "_part"], "left")
            .withColumn("_salt", F.when(mixed, F.col("_salt")).otherwise(F.lit(0)))
            .drop("_hot")
        )
        counts = sizes(tagged)
    before = Window.partitionBy("shard").orderBy("_part", "_salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_below", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    tied = F.md5(F.coalesce(F.col(tie).cast("string"), F.lit("")))
    within = Window.partitionBy(*place_keys).orderBy("_order", F.col(key), tied)
    slot = F.row_number().over(within) - 1 + F.col("_below")
    return (
        tagged.join(offsets, place_keys)
        .withColumn("slot", slot.cast("bigint"))
        .drop("_order", "_part", "_salt", "_below")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 39, by key; sizes and checksums of their texts."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return place(table(spark, sf_dir, "documents")).select(
        "doc_id",
        (F.octet_length(text) + 16).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        "shard",
        "slot",
        "grown_shard",
    )


#: The reflected polynomial of CRC-32, worked out bit by bit on the hex digits of the text.
ORACLE = """
WITH draws AS (
  SELECT doc_id, text, s AS shard,
    -ln((('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || ':' || s), 1, 13))::BIGINT + 0.5e0)
      / 4503599627370496e0) AS cost
  FROM documents, (SELECT unnest(range(0, 41)) AS s)),
best AS (
  SELECT doc_id, any_value(text) AS text,
    arg_min(shard, cost) FILTER (shard < 40) AS shard, arg_min(shard, cost) AS grown_shard,
    (('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || ':slot'), 1, 13))::BIGINT + 0.5e0)
      / 4503599627370496e0 AS o
  FROM draws GROUP BY doc_id),
steps AS (
  SELECT list_transform(range(0, 256), lambda b: list_reduce(
    list_prepend(b, range(0, 8)),
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
bytes AS (
  SELECT doc_id, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
    lambda h: ('0x' || h)::BIGINT) AS b FROM documents),
crcs AS (
  SELECT doc_id, xor(list_reduce(list_prepend(4294967295, b),
    lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8)), 4294967295) AS text_crc32
  FROM bytes, steps)
SELECT doc_id, strlen(coalesce(text, ''))::BIGINT + 16 AS size, text_crc32::BIGINT AS text_crc32,
  'key' AS law, shard::INT AS shard,
  row_number() OVER (PARTITION BY shard ORDER BY o, doc_id, md5(coalesce(text, ''))) - 1 AS slot,
  grown_shard::INT AS grown_shard
FROM best JOIN crcs USING (doc_id)
"""
