"""Alignment of two tokenizations by divide and conquer at shared cuts.

Both tokenizations spell the same bytes, so the places where tokens of both
end cut them into groups. Within an interval a common end is looked for near
the middle: token ends of one side, nearest to its middle first, are sought by
bisection among those of the other. A cut found splits the interval into two,
an interval without one is a leaf, that is a group. All intervals of many
documents are halved together, one level after the other.

The links of a document, pairs of ids whose tokens end together, are counted
over the corpus. Documents are dealt with in chunks: each chunk asks for the
counts of its distinct pairs once, so what is shuffled for counting is pairs
of chunks, not of documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from celltide.llm.common import table, without
from celltide.llm.vocab import ByteVocabulary, column, slices
from celltide.sources.workspace import Workspace

PIECES = public_tokenizers.path("piece_bpe_32k.model")
#: A chunk ends after so many documents or links (a longer document is a chunk by itself).
CHUNK_DOCS, CHUNK_LINKS = 4096, 1 << 21
#: An interval of fewer tokens is not halved any more.
SHORT = 16
#: How much farther from the middle each further look goes.
WIDER = 8
_B_BITS = 32
_SPACE = "\u2581"


class PieceVocabulary:
    """A sentencepiece model; its bytes are read on the driver and shipped to the tasks (half a MB)."""

    def __init__(self, path: str = PIECES) -> None:
        with open(path, "rb") as model:
            self.model = model.read()

    def __getstate__(self) -> dict:
        return {"model": self.model}

    def _ready(self) -> sentencepiece.SentencePieceProcessor:
        if not hasattr(self, "_processor"):
            self._processor = sentencepiece.SentencePieceProcessor(model_proto=self.model)
        return self._processor

    def encode(self, text: str) -> np.ndarray:
        return np.array(self._ready().encode(text), np.uint32)

    def token_bytes(self) -> list[bytes]:
        """The bytes of each id: U+2581 stands for a space, ``<0xHH>`` for a byte."""
        processor = self._ready()
        pieces = ((i, processor.id_to_piece(i)) for i in range(processor.get_piece_size()))
        return [
            bytes([int(p[3:5], 16)]) if processor.is_byte(i) else p.replace(_SPACE, " ").encode() for i, p in pieces
        ]


def _near_middle(a: np.ndarray, b: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each interval ``lo .. hi`` of ``a``, the place of the common end nearest to its middle, and its place in ``b``.

    -1 where no end before the last one is common. Looks at the middle, then
    ever farther from it on both sides, and so at each end once at most.
    """
    middle = (lo + hi - 1) // 2
    found = np.searchsorted(b, a[middle])
    common = b[found] == a[middle]
    at_a, at_b = np.where(common, middle, -1), np.where(common, found, -1)
    todo, inner, outer = np.flatnonzero(~common & (hi - lo > 1)), 1, WIDER
    while len(todo):
        low, high, mid = lo[todo], hi[todo] - 1, middle[todo]
        starts = [np.maximum(low, mid - outer + 1), mid + inner]
        ends = [mid - inner, np.minimum(high, mid + outer - 1)]
        owner, place = [], []
        for start, end in zip(starts, ends, strict=True):
            n = np.maximum(end - start + 1, 0)
            owner.append(np.repeat(np.arange(len(todo)), n))
            place.append(np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start, n))
        owner, place = np.concatenate(owner), np.concatenate(place)
        sought = a[place]
        found = np.searchsorted(b, sought)
        common = b[found] == sought
        owner, place, found = owner[common], place[common], found[common]
        order = np.lexsort((np.abs(place - mid[owner]), owner))
        nearest = order[np.flatnonzero(np.diff(owner[order], prepend=-1))]
        at_a[todo[owner[nearest]]], at_b[todo[owner[nearest]]] = place[nearest], found[nearest]
        wider = (at_a[todo] < 0) & ((mid - outer + 1 > low) | (mid + outer - 1 < high))
        todo, inner, outer = todo[wider], outer, outer * WIDER
    return at_a, at_b


def shared_cuts(
    a: np.ndarray, b: np.ndarray, lo_a: np.ndarray, hi_a: np.ndarray, lo_b: np.ndarray, hi_b: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``a`` and ``b`` of all common ends, in order.

    ``a`` and ``b`` rise strictly; intervals ``lo .. hi``, both included, end
    at a common end and hold the same bytes (one interval a document). Those
    of a few tokens are settled at once, by a bisection for each of their ends.
    """
    cuts_a, cuts_b = [hi_a], [hi_b]
    while len(lo_a):
        short = hi_a - lo_a < SHORT
        n = (hi_a - lo_a)[short]
        order = np.argsort(lo_a[short], kind="stable")  # in order of bytes, bisections touch neighbouring memory
        n, start = n[order], lo_a[short][order]
        place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start, n)
        found = np.searchsorted(b, a[place])
        common = b[found] == a[place]
        cuts_a.append(place[common])
        cuts_b.append(found[common])
        lo_a, hi_a, lo_b, hi_b = lo_a[~short], hi_a[~short], lo_b[~short], hi_b[~short]
        divisible = (hi_a > lo_a) & (hi_b > lo_b)  # one token on a side makes a leaf
        lo_a, hi_a, lo_b, hi_b = lo_a[divisible], hi_a[divisible], lo_b[divisible], hi_b[divisible]
        at_a, at_b = _near_middle(a, b, lo_a, hi_a)
        cut = at_a >= 0
        at_a, at_b = at_a[cut], at_b[cut]
        cuts_a.append(at_a)
        cuts_b.append(at_b)
        lo_a, hi_a = np.concatenate([lo_a[cut], at_a + 1]), np.concatenate([at_a, hi_a[cut]])
        lo_b, hi_b = np.concatenate([lo_b[cut], at_b + 1]), np.concatenate([at_b, hi_b[cut]])
    return np.sort(np.concatenate(cuts_a)), np.sort(np.concatenate(cuts_b))


@dataclass(frozen=True)
class Alignment:
    """Tokens of some documents one after the other, their cuts, and where each document begins in all of these."""

    a: np.ndarray
    b: np.ndarray
    cuts_a: np.ndarray
    cuts_b: np.ndarray
    from_a: np.ndarray
    from_b: np.ndarray
    from_cut: np.ndarray


class Aligner:
    """Encodes texts by two vocabularies and aligns the tokens."""

    def __init__(self, a: ByteVocabulary, b: PieceVocabulary) -> None:
        self.a, self.b = a, b

    def __getstate__(self) -> dict:
        return {"a": self.a, "b": self.b}

    def _ready(self) -> None:
        if not hasattr(self, "_bytes"):
            self._bytes = tables = (self.a.token_bytes(), self.b.token_bytes())
            self._lengths = [np.array([len(t) for t in tokens], np.int64) for tokens in tables]

    def _tokens(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids by both; none unless both spell the text with a space before it."""
        none = np.zeros(0, np.uint32)
        if not text:
            return none, none
        spaced = f" {text}"
        found, data = (self.a.encode(spaced), self.b.encode(text)), spaced.encode()
        if self.a.decode(found[0]) != data or b"".join(map(self._bytes[1].__getitem__, found[1].tolist())) != data:
            return none, none
        return found

    def align(self, texts: list[str | None]) -> Alignment:
        """All texts together; one that has no tokens has no cuts either."""
        self._ready()
        tokens = [self._tokens(t) for t in texts]
        a, b = (np.concatenate([t[side] for t in tokens]) for side in (0, 1))
        from_a, from_b = (np.cumsum([0, *(len(t[side]) for t in tokens)]) for side in (0, 1))
        some = np.flatnonzero(np.diff(from_a))
        ends_a, ends_b = np.cumsum(self._lengths[0][a]), np.cumsum(self._lengths[1][b])
        whole = (from_a[some], from_a[some + 1] - 1, from_b[some], from_b[some + 1] - 1)
        cuts_a, cuts_b = shared_cuts(ends_a, ends_b, *whole)
        return Alignment(a, b, cuts_a, cuts_b, from_a, from_b, np.searchsorted(cuts_a, from_a))


def _decimals(n: int, last: str) -> np.ndarray:
    """Decimal ids as bytes: followed by a comma, and, n places on, by ``last``."""
    return np.array([f"{i}{mark}".encode() for mark in (",", last) for i in range(n)], object)


class _Digests:
    """sha256 of each document's groups, written ``a1,a2|b1;a3|b2,b3``."""

    def __init__(self, n_a: int, n_b: int) -> None:
        self.n_a, self.n_b, self.of_a, self.of_b = n_a, n_b, _decimals(n_a, "|"), _decimals(n_b, ";")

    def of(self, found: Alignment) -> list[str]:
        last_a, last_b = np.zeros(len(found.a), np.int64), np.zeros(len(found.b), np.int64)
        last_a[found.cuts_a], last_b[found.cuts_b] = 1, 1
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        written = np.empty(len(found.a) + len(found.b), object)
        before = np.concatenate([[0], found.cuts_b + 1])  # tokens of b in the groups before
        written[np.arange(len(found.a)) + before[group_a]] = self.of_a[found.a + self.n_a * last_a]
        written[np.arange(len(found.b)) + (found.cuts_a + 1)[group_b]] = self.of_b[found.b + self.n_b * last_b]
        ends = (found.from_a + found.from_b).tolist()
        return [
            hashlib.sha256(b"".join(written[lo:hi].tolist())[:-1]).hexdigest() if hi > lo else ""
            for lo, hi in zip(ends, ends[1:], strict=False)
        ]


def groups(docs: DataFrame, aligner: Aligner, text: str = "text") -> DataFrame:
    """Every row with ``groups``: an array of ``a`` and ``b``, the ids of a group by either vocabulary.

    Null and empty texts, and texts that a vocabulary does not spell byte for
    byte, have no groups. An input column of that name is replaced; equal rows
    get equal groups. One pass without shuffle.
    """
    kept = without(docs, ["groups"])
    names = kept.columns
    kind = T.ArrayType(T.IntegerType())
    schema = T.StructType([*kept.schema.fields]).add(
        "groups", T.ArrayType(T.StructType([T.StructField("a", kind), T.StructField("b", kind)]))
    )

    def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches):
            found = aligner.align(column(rows, text).to_pylist())
            sides = []
            for ids, cuts in ((found.a, found.cuts_a), (found.b, found.cuts_b)):
                ends = np.concatenate([[0], cuts + 1]).astype(np.int32)
                sides.append(pa.ListArray.from_arrays(ends, ids.astype(np.int32)))
            pairs = pa.StructArray.from_arrays(sides, ["a", "b"])
            lists = pa.ListArray.from_arrays(found.from_cut.astype(np.int32), pairs)
            yield pa.RecordBatch.from_pydict(dict(zip(names, rows.columns, strict=True)) | {"groups": lists})

    return kept.mapInArrow(grouped, schema)


_CHUNKS = (
    ("n_a", T.LongType()), ("n_b", T.LongType()), ("n_links", T.LongType()), ("groups_sha256", T.StringType()),
    ("codes", T.BinaryType()), ("times", T.BinaryType()), ("pairs", T.BinaryType()), ("chunk", T.LongType()),
)
_OF_DOC = ("_key", "n_a", "n_b", "n_links", "groups_sha256", "codes", "times")
_ANSWER = (("code", "bigint"), ("total", "bigint"), ("best", "boolean"))


def _code_type(n_pairs: int) -> str:
    """Codes of a chunk with so many pairs: two bytes where these do."""
    return "<u2" if n_pairs <= 1 << 16 else "<u4"


def _chunks(docs: DataFrame, aligner: Aligner, key: str, text: str) -> DataFrame:
    """A row per document, with the codes of its links, and one per chunk, with the pairs that the codes stand for.

    Both have ``times``: how often a document has each of its codes, which
    come sorted, and a chunk each of its pairs.
    """
    schema = T.StructType([T.StructField("_key", docs.schema[key].dataType), *(T.StructField(n, t) for n, t in _CHUNKS)])

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digests = _Digests(len(aligner.a.token_bytes()), len(aligner.b.token_bytes()))
        chunk = TaskContext.get().partitionId() << 32
        waiting: list[tuple[pa.Array, Alignment, list[str]]] = []
        links: list[np.ndarray] = []

        def rows(keys: pa.Array, n: int, **values: list) -> pa.RecordBatch:
            made = {"_key": keys}
            for name, kind in _CHUNKS:
                of_kind = {T.LongType: pa.int64(), T.StringType: pa.string(), T.BinaryType: pa.binary()}[type(kind)]
                made[name] = pa.array(values.get(name, [None] * n), of_kind)
            return pa.RecordBatch.from_pydict(made | {"chunk": pa.array([chunk] * n, pa.int64())})

        def ended() -> Iterator[pa.RecordBatch]:
            every = np.concatenate(links)
            pairs, code, times = np.unique(every, return_inverse=True, return_counts=True)
            code = code.astype(_code_type(len(pairs)))
            at = 0
            for keys, found, sha in waiting:
                ends = (at + found.from_cut).tolist()
                own = [np.unique(code[lo:hi], return_counts=True) for lo, hi in zip(ends, ends[1:], strict=False)]
                codes, counts = [c.tobytes() for c, _ in own], [n.astype("<u4").tobytes() for _, n in own]
                at = ends[-1]
                n_a, n_b, n_links = (np.diff(v) for v in (found.from_a, found.from_b, found.from_cut))
                yield rows(
                    keys, len(keys), n_a=n_a, n_b=n_b, n_links=n_links, groups_sha256=sha, codes=codes, times=counts
                )
            yield rows(pa.nulls(1, keys.type), 1, pairs=[pairs.astype("<i8").tobytes()], times=[times.astype("<u4").tobytes()])

        for batch in slices(batches):
            found = aligner.align(column(batch, "_text").to_pylist())
            ends = found.a[found.cuts_a].astype(np.int64) << _B_BITS | found.b[found.cuts_b].astype(np.int64)
            links.append(ends)
            # tokens are not needed once digests are made
            light = Alignment(found.a[:0], found.b[:0], found.cuts_a[:0], found.cuts_b[:0], found.from_a, found.from_b, found.from_cut)
            waiting.append((column(batch, "_key"), light, digests.of(found)))
            if sum(map(len, links)) >= CHUNK_LINKS or sum(len(w[0]) for w in waiting) >= CHUNK_DOCS:
                yield from ended()
                waiting, links, chunk = [], [], chunk + 1
        if waiting:
            yield from ended()

    return docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).mapInArrow(aligned, schema)


def _asked(chunks: DataFrame) -> DataFrame:
    """``pair, chunk, code, n``: the distinct pairs of each chunk."""

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, 1):
            pairs = np.frombuffer(column(rows, "pairs")[0].as_py(), "<i8")
            times = np.frombuffer(column(rows, "times")[0].as_py(), "<u4").astype(np.int64)
            chunk = np.full(len(pairs), column(rows, "chunk")[0].as_py())
            code = np.arange(len(pairs), dtype=np.int64)
            yield pa.RecordBatch.from_pydict({"pair": pairs, "chunk": chunk, "code": code, "n": times})

    asked = chunks.where("pairs IS NOT NULL").select("pairs", "times", "chunk")
    return asked.mapInArrow(told, "pair bigint, chunk bigint, code bigint, n bigint")


def pair_counts(asked: DataFrame) -> DataFrame:
    """``pair, total, best``: how many links hold a pair, and whether no other pair of its id of ``b`` has more."""
    totals = asked.groupBy("pair").agg(F.sum("n").alias("total"))
    b = F.col("pair").bitwiseAND(F.lit((1 << _B_BITS) - 1))
    totals = totals.withColumn("b", b)
    most = totals.groupBy("b").agg(F.max("total").alias("most"))
    return totals.join(most, "b").select("pair", "total", (F.col("total") == F.col("most")).alias("best"))


def agreement(docs: DataFrame, aligner: Aligner, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every row.

    A link is a pair of tokens that end together, its count the number of
    links of all documents with the same two ids. ``n_best`` are the links
    whose count no other id of ``a`` surpasses for that id of ``b``, ties
    included; ``count_sum`` adds the counts up. Null and empty texts, and
    texts that a vocabulary does not spell byte for byte, have zeros and an
    empty digest. Rows that repeat count, and are told, each time; null keys
    are kept. An empty table gives no rows. Other columns are not looked at.
    """
    workspace = Workspace(docs.sparkSession)
    chunks = workspace.stage(_chunks(docs, aligner, key, text), "chunks")
    asked = _asked(chunks)
    counts = workspace.stage(pair_counts(asked), "counts")
    of_no_doc = (F.lit(None).cast(chunks.schema[n].dataType).alias(n) for n in _OF_DOC)
    answers = asked.join(counts, "pair").select("chunk", F.lit(0).alias("kind"), "code", "total", "best", *of_no_doc)
    no_answer = (F.lit(None).cast(t).alias(n) for n, t in _ANSWER)
    asking = chunks.where("pairs IS NULL").select("chunk", F.lit(1).alias("kind"), *no_answer, *_OF_DOC)
    by = ("chunk", "kind", "code")
    together = answers.unionByName(asking).repartition("chunk").sortWithinPartitions(*by)
    schema = T.StructType([chunks.schema[n] for n in _OF_DOC[:-2]])
    schema = schema.add("n_best", T.LongType()).add("count_sum", T.LongType())

    def answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, telling = None, False
        total, best = [], []
        for rows in slices(batches, 8192):
            changes = np.flatnonzero(np.diff(column(rows, "chunk").to_numpy() * 2 + column(rows, "kind").to_numpy())) + 1
            for lo, hi in zip([0, *changes], [*changes, rows.num_rows], strict=True):
                run = rows.slice(int(lo), int(hi - lo))
                of_chunk, is_doc = column(run, "chunk")[0].as_py(), column(run, "kind")[0].as_py() == 1
                if of_chunk != chunk:
                    chunk, telling, total, best = of_chunk, False, [], []
                if not is_doc:
                    total.append(column(run, "total").to_numpy())
                    best.append(column(run, "best").to_numpy(zero_copy_only=False).astype(np.int64))
                    continue
                if not telling:  # all answers of the chunk have come
                    none = np.zeros(0, np.int64)
                    totals, bests, telling = np.concatenate([none, *total]), np.concatenate([none, *best]), True
                kind = _code_type(len(totals))
                n_best, count_sum = [], []
                for code, often in zip(column(run, "codes").to_pylist(), column(run, "times").to_pylist(), strict=True):
                    own, n = np.frombuffer(code, kind), np.frombuffer(often, "<u4").astype(np.int64)
                    n_best.append(int(bests[own] @ n))
                    count_sum.append(int(totals[own] @ n))
                made = {n: column(run, n) for n in _OF_DOC[:-2]}
                yield pa.RecordBatch.from_pydict(
                    made | {"n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(count_sum, pa.int64())}
                )

    told = together.mapInArrow(answered, schema)
    return told.select(
        F.col("_key").alias(key), "n_a", "n_b", F.col("n_links").alias("n_groups"), "n_links", "n_best", "count_sum", "groups_sha256"
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the two vocabularies' tokens of all documents align."""
    return agreement(table(spark, sf_dir, "documents"), Aligner(ByteVocabulary(), PieceVocabulary()))
