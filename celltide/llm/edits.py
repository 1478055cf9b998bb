"""Edit-aware token counts: a segment tree of pre-tokens per document, re-encoded only where edits touch it.

The leaves of a tree are runs of neighbouring pre-tokens with their numbers of
characters and tokens; inner nodes hold the sums. An edit finds its leaf by
going down the sums, re-encodes from there until pre-tokens end where old
leaves ended, and renews the sums above what changed. The root has the count.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from celltide.llm.bpe import Codec, read_ranks
from celltide.llm.common import table, without

RUN = 32
#: How far a pre-token's end may depend on what follows it: the splitting pattern looks two characters ahead at most.
CONTEXT = 2
EDITS = "array<struct<at:bigint,removed:bigint,inserted:string>>"
_CACHED, _CACHED_CHARS = 400_000, 48
_CHARS_AT_ONCE, _PIECES_AT_ONCE = 1_000_000, 100_000


class _Counts(dict):
    """Numbers of tokens of pre-tokens; those of the short ones met so far are kept, up to a bound."""

    def __init__(self, codec: Codec) -> None:
        ranks = {token: rank for rank, token in enumerate(codec.tokens)}
        self.encode = tiktoken.Encoding(
            "ranks", pat_str=codec.pattern, mergeable_ranks=ranks, special_tokens={}
        ).encode_ordinary

    def __missing__(self, piece: str) -> int:
        n = len(self.encode(piece))
        if len(piece) <= _CACHED_CHARS:
            if len(self) >= _CACHED:
                self.clear()
            self[piece] = n
        return n


class _Counter:
    """What a task needs to count by a codec: its pattern, and ``count``, from pre-tokens to numbers of tokens."""

    def __init__(self, codec: Codec) -> None:
        self.regex, self.count = regex.compile(codec.pattern), _Counts(codec).__getitem__

    @staticmethod
    def of(codec: Codec) -> _Counter:
        """That of a codec, made once in each task; it is not shipped."""
        if not hasattr(codec, "_counter"):
            codec._counter = _Counter(codec)
        return codec._counter

    def parts(self, text: str) -> Iterator[list[str]]:
        """All pre-tokens; those of a very long text come in parts, so that memory stays bounded."""
        if len(text) <= _CHARS_AT_ONCE:
            yield self.regex.findall(text)
            return
        found = (m.group() for m in self.regex.finditer(text))
        while part := list(islice(found, _PIECES_AT_ONCE)):
            yield part


_NONE = np.zeros(0, np.int64)


class Tree:
    """Sums of characters and tokens over the leaves ``width ..`` of a heap; node i is the sum of 2i and 2i + 1."""

    def __init__(self, chars: np.ndarray, tokens: np.ndarray) -> None:
        width = 1
        while width < len(chars):
            width *= 2
        self.width, self.leaves = width, len(chars)
        self.chars, self.tokens = np.zeros(2 * width, np.int64), np.zeros(2 * width, np.int64)
        for sums, values in ((self.chars, chars), (self.tokens, tokens)):
            sums[width : width + len(values)] = values
            at = width
            while at > 1:
                sums[at // 2 : at] = sums[at : 2 * at].reshape(-1, 2).sum(axis=1)
                at //= 2

    @classmethod
    def stored(cls, leaves: int, chars: np.ndarray, tokens: np.ndarray) -> Tree:
        """A tree from its written sums."""
        tree = cls.__new__(cls)
        tree.width, tree.leaves = len(chars) // 2, leaves
        tree.chars, tree.tokens = chars.astype(np.int64), tokens.astype(np.int64)
        return tree

    @property
    def n_tokens(self) -> int:
        return int(self.tokens[1])

    def first_ending_at(self, place: int) -> tuple[int, int]:
        """The first leaf that ends at ``place`` or later, and where it begins; the last leaf if none does."""
        if place > self.chars[1]:
            place = int(self.chars[1])
        node, before = 1, 0
        while node < self.width:
            node *= 2
            if before + self.chars[node] < place:
                before += int(self.chars[node])
                node += 1
        return node - self.width, before

    def renew(self, first: int, chars: np.ndarray, tokens: np.ndarray) -> None:
        """Replace leaves from ``first`` on, and the sums above them only."""
        for leaf, (of_chars, of_tokens) in enumerate(zip(chars.tolist(), tokens.tolist(), strict=True), self.width + first):
            more_chars, more_tokens = of_chars - int(self.chars[leaf]), of_tokens - int(self.tokens[leaf])
            while leaf:
                self.chars[leaf] += more_chars
                self.tokens[leaf] += more_tokens
                leaf //= 2

    def replace(self, first: int, last: int, chars: np.ndarray, tokens: np.ndarray) -> Tree:
        """The tree with leaves ``first .. last - 1`` replaced; built anew only if their number changes."""
        if len(chars) == last - first:
            self.renew(first, chars, tokens)
            return self
        leaves = slice(self.width, self.width + self.leaves)
        old_chars, old_tokens = self.chars[leaves], self.tokens[leaves]
        return Tree(
            np.concatenate([old_chars[:first], chars, old_chars[last:]]),
            np.concatenate([old_tokens[:first], tokens, old_tokens[last:]]),
        )


def _runs(chars: list[int], tokens: list[int], into: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums over ``into`` runs of about equal length, or, if these got longer than two, over runs of ``RUN`` pre-tokens."""
    n = len(chars)
    if into and n <= 2 * RUN * into:
        cuts = [i * n // into for i in range(into + 1)]
    else:
        cuts = [*range(0, n, RUN), n]
    sums = [[sum(values[lo:hi]) for lo, hi in zip(cuts, cuts[1:], strict=False)] for values in (chars, tokens)]
    return np.array(sums[0], np.int64), np.array(sums[1], np.int64)


def build_tree(text: str, codec: Codec) -> Tree:
    """The tree of a whole text; an empty one has no leaves."""
    counter, chars, tokens = _Counter.of(codec), [], []
    for pieces in counter.parts(text):  # parts of a long text are whole runs
        n = len(pieces)
        runs = np.arange(0, n, RUN)
        chars.append(np.add.reduceat(np.fromiter(map(len, pieces), np.int64, n), runs) if n else _NONE)
        tokens.append(np.add.reduceat(np.fromiter(map(counter.count, pieces), np.int64, n), runs) if n else _NONE)
    return Tree(np.concatenate(chars), np.concatenate(tokens))


def edit(text: str, tree: Tree, at: int, removed: int, inserted: str, codec: Codec) -> tuple[str, Tree, int]:
    """The edited text, its tree, and how many pre-tokens were encoded for it.

    ``at`` and ``removed`` are code points; what lies outside the text is cut off.
    """
    counter = _Counter.of(codec)
    at = min(max(at, 0), len(text))
    removed = min(max(removed, 0), len(text) - at)
    if not removed and not inserted:
        return text, tree, 0
    text = text[:at] + inserted + text[at + removed :]
    if not tree.leaves:
        return text, build_tree(text, codec), sum(map(len, counter.parts(text)))
    first, place = tree.first_ending_at(at - CONTEXT)
    grown, behind = len(inserted) - removed, at + removed
    # old leaf ends, as they lay before the edit
    last, end = first, place
    of_leaf, leaves = tree.chars.item, tree.leaves
    chars: list[int] = []
    tokens: list[int] = []
    met = False
    for found in counter.regex.finditer(text, place):
        before, place = place, found.end()
        chars.append(place - before)
        tokens.append(counter.count(found.group()))
        while last < leaves and (end < behind or end + grown < place):
            end += of_leaf(tree.width + last)
            last += 1
        if end >= behind and end + grown == place:
            met = True
            break
    if not met:
        last = leaves
    changed = _runs(chars, tokens, last - first)
    return text, tree.replace(first, last, *changed), len(chars)


def _value(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 128) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def _lists(values: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, values)]).astype(np.int32)
    return pa.ListArray.from_arrays(ends, np.concatenate(values).astype(np.int32))


_STATE = [
    T.StructField("n_tokens", T.LongType()),
    T.StructField("tree_leaves", T.IntegerType()),
    T.StructField("tree_chars", T.ArrayType(T.IntegerType())),
    T.StructField("tree_tokens", T.ArrayType(T.IntegerType())),
]


def _state(trees: list[Tree]) -> dict[str, pa.Array]:
    return {
        "n_tokens": pa.array([t.n_tokens for t in trees], pa.int64()),
        "tree_leaves": pa.array([t.leaves for t in trees], pa.int32()),
        "tree_chars": _lists([t.chars for t in trees]),
        "tree_tokens": _lists([t.tokens for t in trees]),
    }


def count_tokens(docs: DataFrame, codec: Codec, text: str = "text") -> DataFrame:
    """Every row with ``n_tokens`` and its tree: ``tree_leaves, tree_chars, tree_tokens``.

    Null and empty texts have 0 tokens and a tree without leaves. Input
    columns of these names are replaced. One pass, no shuffle.
    """
    kept = without(docs, [f.name for f in _STATE])
    names = kept.columns

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _slices(batches):
            trees = [build_tree(v.as_py() or "", codec) for v in _value(rows, text)]
            yield pa.RecordBatch.from_pydict(dict(zip(names, rows.columns, strict=True)) | _state(trees))

    return kept.mapInArrow(counted, T.StructType([*kept.schema.fields, *_STATE]))


def apply_edits(counted: DataFrame, codec: Codec, text: str = "text", edits: str = "edits") -> DataFrame:
    """Rows of ``count_tokens`` after their edits: text, count and tree renewed, ``n_encoded`` added.

    ``edits`` is an array of ``at, removed, inserted`` per row, applied one
    after the other, positions in code points of the text as it then is. What
    lies outside the text is cut off; null removes or inserts nothing, and an
    edit that is null or has no place is left out. ``n_encoded`` counts the
    pre-tokens that were encoded. A null text is edited as an empty one, and
    stays null if nothing is inserted. Equal rows give equal rows.
    """
    kept = without(counted, ["n_encoded"])
    names = kept.columns

    def one(value: str | None, tree: Tree, changes: list | None) -> tuple[str | None, Tree, int]:
        now, encoded = value or "", 0
        for change in changes or []:
            if change is None or change["at"] is None:
                continue
            now, tree, n = edit(now, tree, change["at"], change["removed"] or 0, change["inserted"] or "", codec)
            encoded += n
        return (None if value is None and not now else now), tree, encoded

    def edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _slices(batches):
            texts, trees, counts = [], [], []
            sums = (_value(rows, "tree_leaves"), _value(rows, "tree_chars"), _value(rows, "tree_tokens"))
            for value, leaves, chars, tokens, changes in zip(_value(rows, text), *sums, _value(rows, edits), strict=True):
                tree = Tree.stored(leaves.as_py(), chars.values.to_numpy(), tokens.values.to_numpy())
                now, tree, n = one(value.as_py(), tree, changes.as_py())
                texts.append(now)
                trees.append(tree)
                counts.append(n)
            added = _state(trees) | {text: pa.array(texts, pa.string()), "n_encoded": pa.array(counts, pa.int64())}
            yield pa.RecordBatch.from_pydict(dict(zip(names, rows.columns, strict=True)) | added)

    return kept.mapInArrow(edited, T.StructType([*kept.schema.fields, T.StructField("n_encoded", T.LongType())]))


def derived_edits(docs: DataFrame, key: str = "doc_id", text: str = "text", number: int = 3) -> DataFrame:
    """Adds ``edits``: for each document some cuts and moves of its own text, placed by hashes of its key.

    Edit k removes up to 39 code points; all but every third insert up to 29
    code points copied from elsewhere in the text. A null or empty text has
    edits that change nothing. Places depend on the key and the text's length
    alone, so rows that repeat get equal edits, and null keys one draw. An
    input column ``edits`` is replaced; an empty table stays empty.
    """
    length = F.char_length(F.coalesce(F.col(text), F.lit("")))
    draw = lambda what, k, below: F.pmod(F.xxhash64(F.lit(what), F.lit(k), F.col(key)), below)
    made = []
    for k in range(number):
        start, size = draw("from", k, length + 1) + 1, draw("size", k, F.lit(30 if k % 3 else 1))
        inserted = F.substr(F.coalesce(F.col(text), F.lit("")), start.cast("int"), size.cast("int"))
        at, removed = draw("at", k, length + 1), draw("removed", k, F.lit(40))
        made.append(F.struct(at.alias("at"), removed.alias("removed"), inserted.alias("inserted")))
    return without(docs, ["edits"]).withColumn("edits", F.array(*made).cast(EDITS))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents before and after edits derived from each, and what the edits cost."""
    codec = Codec(read_ranks())
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = count_tokens(derived_edits(docs), codec).withColumn("tokens_before", F.col("n_tokens"))
    edited = apply_edits(counted, codec)
    return edited.select(
        "doc_id",
        "tokens_before",
        F.col("n_tokens").alias("tokens_after"),
        "n_encoded",
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"),
    )
