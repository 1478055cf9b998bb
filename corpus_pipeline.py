"""The corpus pipeline: documents through five of the operators, one after the other.

Each stage works on all that the one before kept, and its decisions take
effect: rejected documents and near-duplicates go, secrets are masked, sources
are repeated or thinned to their shares, and the rest is encoded.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from celltide.llm import bpe, minhash, mixing, quality, secrets
from celltide.llm.common import table
from celltide.sources.workspace import Workspace

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def accepted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor the learned list reject.

    Null and empty texts have no words and go. Very long texts are judged as a
    whole; rows that repeat are judged alike, null keys like others. Columns
    are those of the input; an empty table stays empty.
    """
    judged = quality.judge(docs, table(spark, sf_dir, "labels"), Workspace(spark))
    return judged.where("kept").select(docs.columns)


def different(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates.

    That of the smallest key; of rows equal in key and text any one. Texts
    without words are no group and all stay. Very long texts are compared as a
    whole; columns are those of the input; an empty table stays empty.
    """
    return minhash.survivors(docs)


def masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced and ``n_chars`` counted anew where they were.

    Null texts stay null; without ``n_chars`` none is made. Very long texts are
    scanned as a whole, rows that repeat alike. Columns are those of the
    input; an empty table stays empty.
    """
    found = secrets.scan(docs, secrets.train(secrets.labelled_samples(docs)))
    clean = secrets.redact(found)
    if "n_chars" in docs.columns:
        count = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        clean = clean.withColumn("n_chars", F.when(F.size("spans") > 0, count).otherwise(F.col("n_chars")))
    return clean.select(docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as drawn, so that every source has the same share of bytes.

    Null and empty texts weigh nothing and are drawn like others of their
    source; a null source is one more. Rows of one key, or without key, get the
    same number of copies. Columns are those of the input; an empty table
    stays empty.
    """
    return mixing.mix(docs).select(docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document's text, with its key and source.

    Null and empty texts have none; very long ones are encoded as a whole; rows
    that repeat are encoded each time. An empty table gives no rows.
    """
    ids = bpe.encode(docs.select("doc_id", "source", "text"), bpe.Codec(bpe.read_ranks()))
    return ids.select("doc_id", "source", "n_tokens", "ids")


STAGES: list[tuple[str, Stage]] = [
    ("quality", accepted),
    ("near_duplicates", different),
    ("secrets", masked),
    ("mix", mixed),
    ("encode", encoded),
]

#: Learned rules, signatures and tokenizers have no SQL; a test holds the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each stage before it is written as Parquet and read again."""
    workspace = Workspace(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = workspace.stage(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
