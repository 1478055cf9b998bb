"""Best-fit packing of documents into sequences, in bulk-synchronous sweeps.

A sweep range-sorts the places in open sequences and the longest unplaced
pieces by size, larger first, and matches each piece with the smallest place
before it that is still free: the places met so far are a stack. Each range is
matched on its own; what it leaves, pieces without a place and places without
a piece, has a rank in its range, and the stack of whole ranges gives leftover
pieces and places that belong together the same number, by which they are
joined. Then the gaps are renewed, and the next sweep begins.

Only pieces longer than a quarter of the longest one left take part in a
sweep, so short pieces do not use up room that longer ones need. Sequences are
opened only for pieces that fit in no gap, as many as those need at least.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from celltide.llm.common import table
from celltide.llm.vocab import SPECIAL, ByteVocabulary, column, slices
from celltide.sources.workspace import Workspace

CAPACITY = 2048
#: The id that ends a document.
END = 0
#: Pieces longer than the longest one divided by this are placed together.
SPAN = 4
#: Ranges of a sweep: one for so many rows, and so many at least.
ROWS_PER_RANGE, RANGES = 200_000, 8
_PLACE, _PIECE, _PAIR = 0, 1, 2
_EVENTS = "kind int, size bigint, item bigint, sequence bigint, slot int"
_SWEPT = f"{_EVENTS}, part int, rank bigint"


def cut_lengths(n: int, capacity: int) -> list[int]:
    """Lengths of the pieces of n ids: only the first may be shorter than the capacity."""
    first = n % capacity
    return ([first] if first else []) + [capacity] * (n // capacity)


def cut(
    docs: DataFrame, vocabulary: ByteVocabulary, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY
) -> DataFrame:
    """``key, piece, start, length, ids`` of every row's text.

    ``ids`` are little-endian unsigned 32-bit numbers, the end id last. A null
    or empty text is its end id alone; every row gives at least one piece, and
    rows that repeat give theirs again. Other columns are left out.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches):
            which, piece, start, length, ids = [], [], [], [], []
            for i, value in enumerate(column(rows, "_text")):
                found = np.append(vocabulary.encode(value.as_py() or ""), np.uint32(END)).astype("<u4")
                at = 0
                for k, n in enumerate(cut_lengths(len(found), capacity)):
                    which.append(i)
                    piece.append(k)
                    start.append(at)
                    length.append(n)
                    ids.append(found[at : at + n].tobytes())
                    at += n
            yield pa.RecordBatch.from_pydict(
                {
                    key: column(rows, key).take(pa.array(which, pa.int64())),
                    "piece": pa.array(piece, pa.int32()),
                    "start": pa.array(start, pa.int64()),
                    "length": pa.array(length, pa.int64()),
                    "ids": pa.array(ids, pa.binary()),
                }
            )

    schema = T.StructType([docs.schema[key]]).add("piece", T.IntegerType()).add("start", T.LongType())
    schema = schema.add("length", T.LongType()).add("ids", T.BinaryType())
    return docs.select(key, F.col(text).alias("_text")).mapInArrow(pieces, schema)


def _match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One range of a sweep: pairs at once, what is left over with its rank."""
    part = TaskContext.get().partitionId()
    free: list[tuple[int, int, int]] = []  # places met and not taken, the smallest last
    lacking = 0

    def rows(found: list[tuple]) -> pa.RecordBatch:
        values = list(zip(*found, strict=True)) if found else [()] * 7
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64())
        names = ("kind", "size", "item", "sequence", "slot", "part", "rank")
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, kinds, strict=True)], list(names))

    for batch in batches:
        found = []
        events = (column(batch, name).to_pylist() for name in ("kind", "size", "item", "sequence", "slot"))
        for kind, size, item, sequence, slot in zip(*events, strict=True):
            if kind == _PLACE:
                free.append((size, sequence, slot))
            elif free:
                _, sequence, slot = free.pop()
                found.append((_PAIR, size, item, sequence, slot, part, None))
            else:
                found.append((_PIECE, size, item, None, None, part, lacking))
                lacking += 1
        yield rows(found)
    for start in range(0, len(free), 10_000):
        chunk = enumerate(free[start : start + 10_000], start)
        yield rows([(_PLACE, size, None, sequence, slot, part, k) for k, (size, sequence, slot) in chunk])


def _stacked(left: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int, int, int]]:
    """Runs of leftovers that belong together: ``part, kind, lo, hi, number, step``.

    ``left`` has for each range, in order, how many pieces and places it left.
    A later range's pieces take the places of earlier ones from the last
    backwards; the row of rank r, lo <= r < hi, gets ``number + step * (r - lo)``.
    """
    stack: list[list[int]] = []  # range and how many of its places are free
    runs, number = [], 0
    for part, pieces, places in sorted(left):
        at = 0
        while at < pieces and stack:
            below = stack[-1]
            n = min(pieces - at, below[1])
            runs.append((part, _PIECE, at, at + n, number, 1))
            runs.append((below[0], _PLACE, below[1] - n, below[1], number + n - 1, -1))
            at, number, below[1] = at + n, number + n, below[1] - n
            if not below[1]:
                stack.pop()
        if places:
            stack.append([part, places])
    return runs


def _sweep(events: DataFrame, workspace: Workspace, n_events: int) -> DataFrame:
    """All pairs and leftovers of a sweep over ``events``, as rows of ``_SWEPT``."""
    spark = events.sparkSession
    ranges = max(RANGES, n_events // ROWS_PER_RANGE)
    order = [F.col("size").desc(), "kind", "item", "sequence", "slot"]  # no two alike: equal sizes spread over ranges
    sorted_events = events.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    swept = workspace.stage(sorted_events.mapInArrow(_match, _SWEPT), "swept")
    counts = swept.where(F.col("kind") != _PAIR).groupBy("part")
    left = counts.agg(F.count_if(F.col("kind") == _PIECE), F.count_if(F.col("kind") == _PLACE)).collect()  # two numbers a range
    runs = _stacked([tuple(r) for r in left])
    if not runs:
        return swept
    of_range: dict[tuple[int, int], list[tuple]] = {}
    for part, kind, *run in runs:
        of_range.setdefault((part, kind), []).append(tuple(run))
    named = spark.createDataFrame(
        [(*k, v) for k, v in of_range.items()],
        "part int, kind int, runs array<struct<lo:bigint,hi:bigint,number:bigint,step:int>>",
    )
    within = F.get(F.filter("runs", lambda r: (F.col("rank") >= r.lo) & (F.col("rank") < r.hi)), F.lit(0))
    numbered = swept.join(F.broadcast(named), ["part", "kind"], "left").withColumn("run", within)  # four runs a range at most
    numbered = numbered.withColumn("pair", F.expr("run.number + run.step * (rank - run.lo)")).drop("runs", "run")
    pieces = numbered.where(F.col("kind") == _PIECE).select("pair", "size", "item", "part", "rank")
    places = numbered.where(F.col("kind") == _PLACE).select("pair", "sequence", "slot")
    late = pieces.join(places, "pair").withColumn("kind", F.lit(_PAIR))
    return numbered.where("pair IS NULL").select(*swept.columns).unionByName(late.select(*swept.columns))


def _slots(places: dict[int, int], pieces: dict[int, int], longest: int) -> tuple[int, int]:
    """The widest gap that is needed to place the pieces longer than ``longest / SPAN``, and how many slots it offers.

    A gap of k times the longest piece offers k slots, and all pieces fit in
    all of these; so no more are offered than there are pieces.
    """
    wanted = sum(n for size, n in pieces.items() if size * SPAN > longest)
    for gap in sorted(g for g in places if g >= longest):
        each = gap // longest
        if places[gap] * each >= wanted:
            return gap, max(1, -(-wanted // places[gap]))
        wanted -= places[gap] * each
    return max(places), max(1, max(places) // longest)


def best_fit(pieces: DataFrame, workspace: Workspace, capacity: int = CAPACITY) -> DataFrame:
    """``item, sequence, offset`` for every row of ``pieces`` (``item`` unique and not negative, ``length``).

    Lengths run from 1 to the capacity. No pieces, no rows. The driver sees,
    each sweep, the numbers of pieces and gaps by size (two per unit of
    capacity at most) and of leftovers by range. Sweeps are written, so a
    lost executor costs at most one.
    """
    spark = pieces.sparkSession
    none = F.lit(None)
    whole = F.col("length") == capacity
    first = pieces.where(~whole).select(
        F.lit(_PIECE).alias("kind"),
        F.col("length").cast("bigint").alias("size"),
        F.col("item").cast("bigint").alias("item"),
        none.cast("bigint").alias("sequence"),
        none.cast("int").alias("slot"),
    )
    is_piece, is_place = F.col("kind") == _PIECE, F.col("kind") == _PLACE
    state, opened, placed = workspace.stage(first, "state"), 0, []

    def count_sizes(kind: int) -> dict[int, int]:
        return {r["size"]: r["n"] for r in sizes if r["kind"] == kind}

    while True:
        sizes = state.groupBy("kind", "size").agg(F.count(F.lit(1)).alias("n")).collect()  # 2 * capacity rows at most
        unplaced, places = count_sizes(_PIECE), count_sizes(_PLACE)
        if not unplaced:
            break
        longest, shortest = max(unplaced), min(unplaced)
        widest = max(places, default=0)
        if longest > widest:  # open what those too long for any gap need at least
            lacking = {size: n for size, n in unplaced.items() if size > widest and size * SPAN > longest}
            at_least = -(-sum(size * n for size, n in lacking.items()) // capacity)
            new = max(at_least, sum(n for size, n in lacking.items() if 2 * size > capacity))
            fresh = spark.range(opened, opened + new).select(
                F.lit(_PLACE).alias("kind"),
                F.lit(capacity).cast("bigint").alias("size"),
                none.cast("bigint").alias("item"),
                F.col("id").alias("sequence"),
                none.cast("int").alias("slot"),
            )
            state, opened = state.unionByName(fresh), opened + new
            places[capacity] = places.get(capacity, 0) + new
        widest, in_widest = _slots(places, unplaced, longest)
        now = F.col("size") * SPAN > longest
        slots = F.when(F.col("size") == widest, F.lit(in_widest)).otherwise(F.greatest(F.lit(1), F.expr(f"size div {longest}")))
        offered = (
            state.where(is_place & now & (F.col("size") <= widest))
            .withColumn("_slots", slots.cast("int"))
            .withColumn("slot", F.explode(F.sequence(F.lit(0), F.col("_slots") - 1)))
            .withColumn("size", F.expr("size div _slots"))
            .drop("_slots")
        )
        n_events = sum(unplaced.values()) + sum(places.values())
        swept = _sweep(state.where(is_piece & now).unionByName(offered), workspace, n_events)
        pairs = swept.where(F.col("kind") == _PAIR)
        gaps = state.where(is_place).select("sequence", "size")
        gaps = gaps.unionByName(pairs.select("sequence", (-F.col("size")).alias("size")))
        gaps = gaps.groupBy("sequence").agg(F.sum("size").alias("size")).where(F.col("size") >= shortest)
        gaps = gaps.select(
            F.lit(_PLACE).alias("kind"), "size", none.cast("bigint").alias("item"), "sequence", none.cast("int").alias("slot")
        )
        columns = [c for c in state.columns]
        after = [gaps, swept.where(F.col("kind") != _PLACE).select(*columns), state.where(is_piece & ~now)]
        after = workspace.stage(reduce(DataFrame.unionByName, after), "state")
        placed.append(after.where(F.col("kind") == _PAIR).withColumn("sweep", F.lit(len(placed))))
        state = after.where(F.col("kind") != _PAIR)

    alone = pieces.where(whole).select(
        F.col("item").cast("bigint").alias("item"),
        (-F.col("item").cast("bigint") - 1).alias("sequence"),
        F.lit(0).cast("bigint").alias("offset"),
    )
    if not placed:
        return alone
    before = Window.partitionBy("sequence").orderBy("sweep", "slot").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("size").over(before), F.lit(0)).cast("bigint")  # a sequence has capacity pieces at most
    together = reduce(DataFrame.unionByName, placed).withColumn("offset", offset)
    return alone.unionByName(together.select("item", "sequence", "offset"))


def pack(
    docs: DataFrame,
    vocabulary: ByteVocabulary,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    payload: Column | None = None,
) -> DataFrame:
    """The pieces of all rows (see ``cut``) with ``sequence_id`` and ``offset``.

    ``payload`` is what is kept of a piece's ``ids`` (by default the ids
    themselves). Sequences hold at most ``capacity`` ids and have no holes.
    Null and empty texts, repeated rows and null keys are packed like others;
    ties between equal lengths fall as the pieces are numbered. An empty table
    gives no rows. Columns other than key and text are not looked at, so they
    may have any names.
    """
    workspace = Workspace(docs.sparkSession)
    kept = (F.col("ids") if payload is None else payload).alias("ids" if payload is None else "_payload")
    pieces = cut(docs, vocabulary, key, text, capacity).select(F.col(key).alias("_key"), "piece", "start", "length", kept)
    pieces = workspace.stage(pieces.withColumn("item", F.monotonically_increasing_id()), "pieces")
    placed = best_fit(pieces.select("item", "length"), workspace, capacity).withColumnRenamed("sequence", "sequence_id")
    return pieces.join(placed, "item").drop("item").withColumnRenamed("_key", key)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, n_pieces, ids``: the ids of each sequence, pieces in their order."""
    pieces = F.array_sort(F.collect_list(F.struct("offset", "ids")))  # as many as the capacity at most
    joined = F.aggregate("pieces", F.lit(b""), lambda ids, piece: F.concat(ids, piece["ids"]))
    grouped = packed.groupBy("sequence_id").agg(pieces.alias("pieces"))
    return grouped.select("sequence_id", F.size("pieces").alias("n_pieces"), joined.alias("ids"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 2048 ids, with checksums of each piece's ids."""
    docs = table(spark, sf_dir, "documents")
    packed = pack(docs, ByteVocabulary(special=SPECIAL), payload=F.crc32("ids"))
    return packed.select(
        "doc_id", "piece", "start", "length", F.col("_payload").alias("ids_crc32"), "sequence_id", "offset"
    )
