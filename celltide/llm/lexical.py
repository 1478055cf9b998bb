"""Ranked lexical search by norm buckets of impact vectors.

A document is the vector of what each term of the queries adds to a score; a
query is the set of its terms. Documents are ordered by the length of their
vectors and searched in buckets of neighbours. By Cauchy and Schwarz no score
in a bucket exceeds its longest vector times the root of the query's number of
terms, which drops queries from a bucket. Inside, terms are added heaviest
first; the scores so far and bounds on the other coordinates (the bucket's
largest ones, and what is left of each vector's length) filter documents until
none or only whole integer scores remain.

The first bucket of every range of lengths is searched before the rest: its
results give each query a score that ten documents reach, so other tasks drop
what is below it, and only few rows leave them.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from celltide.llm.common import table
from celltide.llm.vocab import column, slices
from celltide.sources.workspace import Workspace

TOP = 10
#: Documents of a bucket, at most; shorter buckets end where vectors are half as long as the first.
BUCKET = 1024
ROWS_PER_RANGE = 100_000
#: Queries searched in one pass over the documents: so many, and so many terms, at most (a longer query goes alone).
BLOCK_ITEMS, BLOCK_TERMS = 2_000, 50_000
_SEGMENT = 1 << 20
_PLACES = (1 << 33) - 1  # of a row within its task, in Spark's row numbers
_TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words(text: str | None) -> Iterator[list[bytes]]:
    """Terms of a text in order, A-Z lower-cased, in parts: those of a very long text are not all held at once."""
    data = (text or "").encode().translate(_TERM_BYTES)
    if len(data) <= _SEGMENT:
        yield data.split()
        return
    start = 0
    while start < len(data):
        end = data.find(b" ", start + _SEGMENT)
        end = len(data) if end < 0 else end
        yield data[start:end].split()
        start = end


@dataclass(frozen=True)
class Block:
    """Queries that are searched together: their ids, and their terms as numbers."""

    ids: list
    queries: list[np.ndarray]
    terms: dict[bytes, int]


def blocks(items: DataFrame, key: str, text: str, most: int = BLOCK_ITEMS, most_terms: int = BLOCK_TERMS) -> Iterator[Block]:
    """The queries block by block; the driver holds one block and one task's rows."""
    ids, queries, terms = [], [], {}
    for row in items.select(F.col(key).alias("k"), F.col(text).alias("t")).toLocalIterator():
        own = {w for part in words(row.t) for w in part}
        if ids and (len(ids) >= most or len(own.union(terms)) > most_terms):
            yield Block(ids, queries, terms)
            ids, queries, terms = [], [], {}
        ids.append(row.k)
        queries.append(np.array(sorted(terms.setdefault(w, len(terms)) for w in sorted(own)), np.int64))
    if ids:
        yield Block(ids, queries, terms)


def _forward(docs: DataFrame, key: str, text: str, terms: dict[bytes, int]) -> DataFrame:
    """``key, n, terms, counts`` of the texts with a term: their length, and the queries' terms in them."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number_of = terms.get
        for rows in slices(batches):
            which, lengths, numbers, counts = [], [], [], []
            for i, value in enumerate(column(rows, "_text")):
                n, found = 0, Counter()
                for part in words(value.as_py()):
                    n += len(part)
                    found.update(map(number_of, part))
                if not n:
                    continue
                found.pop(None, None)
                which.append(i)
                lengths.append(n)
                numbers.append(np.fromiter(found.keys(), "<i4", len(found)).tobytes())
                counts.append(np.fromiter(found.values(), "<i4", len(found)).tobytes())
            yield pa.RecordBatch.from_pydict(
                {
                    "key": column(rows, "_key").take(pa.array(which, pa.int64())),
                    "n": pa.array(lengths, pa.int64()),
                    "terms": pa.array(numbers, pa.binary()),
                    "counts": pa.array(counts, pa.binary()),
                }
            )

    kept = docs.select(F.col(key).cast("bigint").alias("_key"), F.col(text).alias("_text"))
    return kept.mapInArrow(counted, "key bigint, n bigint, terms binary, counts binary")


def _joined(values: pa.Array, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(values.to_pylist()), kind)


def _document_frequencies(forward: DataFrame, n_terms: int) -> np.ndarray:
    """In how many documents each term is; one number per term of a block comes to the driver."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms, np.int64)
        for rows in slices(batches, 4096):
            total += np.bincount(_joined(column(rows, "terms"), "<i4"), minlength=n_terms)
        term = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"term": term, "df": total[term]})

    found = forward.select("terms").mapInArrow(counted, "term bigint, df bigint")
    frequencies = np.zeros(n_terms, np.int64)
    for row in found.groupBy("term").agg(F.sum("df").alias("df")).toLocalIterator():
        frequencies[row.term] = row.df
    return frequencies


def weights(n_docs: int, frequencies: np.ndarray) -> np.ndarray:
    """Integer weight of each term; 0 for one that is in no document."""
    found = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(df) + 1))) if df else 0 for df in frequencies]
    return np.array(found, np.int64)


def _vectors(forward: DataFrame, weight: np.ndarray, n_docs: int, n_words: int) -> DataFrame:
    """``key, terms, adds, norm``: what each term adds to a score, and the length of that vector."""

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, 1024):
            size = np.array([len(v) // 4 for v in column(rows, "terms").to_pylist()], np.int64)
            term, count = _joined(column(rows, "terms"), "<i4"), _joined(column(rows, "counts"), "<i4").astype(np.int64)
            m = 10 + (90 * column(rows, "n").to_numpy() * n_docs) // n_words
            adds = weight[term] * ((1_000_000_000 * count) // (1000 * count + 8 * np.repeat(m, size)))
            ends = np.cumsum(size)
            row_of = np.repeat(np.arange(len(size)), size)
            norm = np.sqrt(np.bincount(row_of, adds.astype(np.float64) ** 2, len(size)))
            cut = np.split(adds, ends[:-1]) if len(size) else []
            yield pa.RecordBatch.from_pydict(
                {
                    "key": column(rows, "key"),
                    "terms": column(rows, "terms"),
                    "adds": pa.array([a.astype("<i8").tobytes() for a in cut], pa.binary()),
                    "norm": norm,
                }
            )

    return forward.mapInArrow(weighed, "key bigint, terms binary, adds binary, norm double").where("norm > 0")


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of neighbours in order of length: a longer vector, one half as long as the first, or the limit ends a run."""
    for rows in slices(batches, BUCKET):
        norm = column(rows, "norm").to_numpy()
        start = 0
        while start < len(norm):
            run = norm[start:]
            ends = np.flatnonzero((np.diff(run, prepend=run[0]) > 0) | (run < run[0] / 2))
            end = start + int(ends[0]) if len(ends) else len(norm)
            yield rows.slice(start, end - start)
            start = end


class _Search:
    """The best rows of each query so far, and the score that others must reach."""

    def __init__(self, queries: list[np.ndarray], weight: np.ndarray, least: np.ndarray, top: int) -> None:
        # heaviest terms first
        self.queries = [q[np.argsort(-weight[q], kind="stable")] for q in (q[weight[q] > 0] for q in queries)]
        self.roots = np.sqrt([len(q) for q in self.queries])
        self.n_terms, self.top = len(weight), top
        self.least = least.copy()
        self.best: list[list[tuple[int, bool, int | None]]] = [[] for _ in queries]

    def bucket(self, rows: pa.RecordBatch) -> None:
        norm = column(rows, "norm").to_numpy()
        active = np.flatnonzero(self.roots * norm.max() * (1 + 1e-9) >= self.least)  # by Cauchy and Schwarz
        if not len(active):
            return
        keys = column(rows, "key").to_pylist()
        size = np.array([len(v) // 4 for v in column(rows, "terms").to_pylist()], np.int64)
        term, adds = _joined(column(rows, "terms"), "<i4"), _joined(column(rows, "adds"), "<i8")
        order = np.argsort(term, kind="stable")
        term, adds, place = term[order], adds[order], np.repeat(np.arange(len(size)), size)[order]
        squares = adds.astype(np.float64) ** 2
        starts = np.searchsorted(term, np.arange(self.n_terms + 1))
        largest = np.zeros(self.n_terms, np.int64)
        there = np.flatnonzero(np.diff(starts))
        largest[there] = np.maximum.reduceat(adds, starts[there]) if len(there) else 0
        norm_squares = norm**2 * (1 + 1e-9)
        for q in active.tolist():
            found = self._candidates(q, starts, largest, place, adds, squares, norm_squares)
            if found is not None:
                self._take(q, keys, *found)

    def _candidates(self, q, starts, largest, place, adds, squares, norm_squares) -> tuple[np.ndarray, np.ndarray] | None:
        """Places and whole scores of the bucket's documents that reach the query's score; None if bounds drop all."""
        terms, least = self.queries[q], self.least[q]
        rest = np.append(np.cumsum(largest[terms][::-1])[::-1], 0)  # what the terms from here on add at most
        if rest[0] < least:
            return None
        score = np.zeros(len(norm_squares), np.int64)
        used = np.zeros(len(norm_squares))
        check = 4
        for k, t in enumerate(terms.tolist(), 1):
            column_of = slice(starts[t], starts[t + 1])
            score[place[column_of]] += adds[column_of]
            used[place[column_of]] += squares[column_of]
            if k == check and k < len(terms):
                check *= 2
                left = np.sqrt((len(terms) - k) * np.maximum(norm_squares - used, 0.0)) * (1 + 1e-9) + 1
                if not (score + np.minimum(left, rest[k]) >= least).any():
                    return None
        reach = np.flatnonzero(score >= least)
        return reach, score[reach]

    def _take(self, q: int, keys: list, places: np.ndarray, scores: np.ndarray) -> None:
        if not len(places):
            return
        if len(places) > self.top:  # those that tie with the last one stay
            last = np.partition(scores, len(scores) - self.top)[-self.top]
            places, scores = places[scores >= last], scores[scores >= last]
        rows = [(-int(s), keys[i] is None, keys[i] or 0) for i, s in zip(places.tolist(), scores.tolist(), strict=True)]
        self.best[q] = sorted(self.best[q] + rows)[: self.top]
        if len(self.best[q]) == self.top:
            self.least[q] = max(self.least[q], -self.best[q][-1][0])


def _searched(vectors: DataFrame, block: Block, weight: np.ndarray, least: np.ndarray, top: int) -> DataFrame:
    """``query, key, score``: each task's best rows of each query that reach its ``least`` score."""
    queries = block.queries

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = _Search(queries, weight, least, top)
        for rows in _buckets(batches):
            state.bucket(rows)
        found = [(q, None if no_key else key, -score) for q, best in enumerate(state.best) for score, no_key, key in best]
        query, key, score = zip(*found, strict=True) if found else ((), (), ())
        yield pa.RecordBatch.from_pydict(
            {"query": pa.array(query, pa.int32()), "key": pa.array(key, pa.int64()), "score": pa.array(score, pa.int64())}
        )

    return vectors.select("key", "terms", "adds", "norm").mapInArrow(search, "query int, key bigint, score bigint")


def _ranked(found: DataFrame, top: int) -> DataFrame:
    """The best rows of each query over all tasks, of which each gave a few."""
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("key").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def _search_block(docs: DataFrame, key: str, text: str, block: Block, top: int, workspace: Workspace) -> DataFrame | None:
    forward = workspace.stage(_forward(docs, key, text, block.terms), "forward")
    n_docs, n_words = forward.agg(F.count(F.lit(1)), F.sum("n")).first()
    if not n_docs or not block.terms:
        return None
    weight = weights(n_docs, _document_frequencies(forward, len(block.terms)))
    vectors = _vectors(forward, weight, n_docs, n_words).withColumn("row", F.monotonically_increasing_id())
    ranges = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), n_docs // ROWS_PER_RANGE)
    order = [F.col("norm").desc(), "row"]  # copies have equal vectors: the row number spreads them
    vectors = vectors.repartitionByRange(ranges, *order).sortWithinPartitions(*order).drop("row")
    place = F.monotonically_increasing_id().bitwiseAND(F.lit(_PLACES))
    vectors = workspace.stage(vectors.withColumn("place", place), "vectors")

    least = np.ones(len(block.queries), np.int64)
    first = _searched(vectors.where(F.col("place") < BUCKET), block, weight, least, top)
    for row in _ranked(first, top).where(F.col("rank") == top).toLocalIterator():  # a row per query at most
        least[row["query"]] = row["score"]
    return workspace.stage(_ranked(_searched(vectors, block, weight, least, top), top), "ranked")


def search(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    top: int = TOP,
    block_items: int = BLOCK_ITEMS,
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """``item_key, rank, key, score``: for every row of ``items`` its ``top`` best rows of ``docs``.

    Null, empty and other texts without a term match nothing; items without
    one, or whose terms are in no document, give no rows. Only scores above 0
    count. Equal scores rank by ascending key (a whole number), a null key
    last; rows that repeat rank one after the other, and so do items, each
    with its own results. No rows in either table give none. Other columns of
    both tables are not looked at. Each block of queries is a pass over all
    documents; counts and weights are always those of all documents.
    """
    spark = docs.sparkSession
    workspace = Workspace(spark)
    item_type = items.schema[item_key].dataType
    schema = T.StructType([T.StructField(item_key, item_type), T.StructField("_query", T.IntegerType())])
    results = []
    for block in blocks(items, item_key, item_text, block_items, block_terms):
        found = _search_block(docs, key, text, block, top, workspace)
        if found is not None:
            ids = spark.createDataFrame([(v, i) for i, v in enumerate(block.ids)], schema)
            named = found.join(F.broadcast(ids), F.col("query") == F.col("_query"))  # a block of ids at most
            results.append(named.select(item_key, "rank", F.col("key").alias(key), "score"))
    if not results:
        empty = T.StructType([schema[0]]).add("rank", T.IntegerType()).add(key, T.LongType()).add("score", T.LongType())
        return spark.createDataFrame([], empty)
    return reduce(DataFrame.unionByName, results)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every benchmark item."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
totals AS (SELECT count(*) AS n_docs, sum(len(w))::BIGINT AS n_words FROM d WHERE len(w) > 0),
counts AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(w) AS n, unnest(w) AS term FROM d) GROUP BY ALL),
asked AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
weight AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM counts GROUP BY term), totals),
scores AS (
  SELECT item_id, doc_id,
    sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_words))))::BIGINT AS score
  FROM asked JOIN counts USING (term) JOIN weight USING (term), totals GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS r FROM scores WHERE score > 0)
SELECT item_id, r::INT AS rank, doc_id, score FROM ranked WHERE r <= 10
"""
