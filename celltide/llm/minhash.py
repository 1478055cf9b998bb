"""MinHash near-duplicates with sequential Bayesian verification.

Documents with equal shingle sets are one node. Nodes meet in buckets of
banded signatures. A pair is compared in batches of its signature: after each
batch it is dropped if the posterior chance that it is similar enough is below
the chosen miss probability. What survives is verified on the full sets.

Not all pairs of a bucket are looked at. First every node is compared with the
most central node it shares a bucket with, one pair per node. These links form
trees; pairs within a tree need no look. The rest of a small bucket is compared
inside a task, which survivors leave as pairs. Large buckets that share nodes
are one cluster, compared in pairs of blocks and verified inside tasks, which
only links that join something leave. Neither way drops a candidate.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from celltide.llm.common import as_key, table
from celltide.llm.components import components, spread_join
from celltide.llm.shingles import MinHasher, Shingler, mixed
from celltide.sources.workspace import Workspace

#: At a similarity of 0.75 a pair shares no bucket with probability (1 - 0.75 ** 5) ** 40, 2e-5.
BANDS, ROWS = 40, 5
SIZE = BANDS * ROWS
BATCH = 40
SIMILARITY = 0.75
MISS = 1e-5
BLOCK = 256
#: The pairs of one central node are dealt into so many shares.
SHARES = 1024


@lru_cache
def least_matches(miss: float = MISS, similarity: float = SIMILARITY) -> tuple[int, ...]:
    """After each batch, the fewest equal places with which a pair is kept.

    With a uniform prior, m equal places of n make a similarity of at least t
    as likely as at most m heads in n + 1 throws of a coin with chance t.
    """
    found = []
    for n in range(BATCH, SIZE + 1, BATCH):
        chance, m = 0.0, -1
        while chance < miss:
            m += 1
            chance += math.comb(n + 1, m) * similarity**m * (1 - similarity) ** (n + 1 - m)
        found.append(m)
    return tuple(found)


def _surviving(left: np.ndarray, right: np.ndarray, a: np.ndarray, b: np.ndarray, least: tuple[int, ...]) -> np.ndarray:
    """Places in ``a, b`` (rows of two signature tables) whose pairs survive every batch."""
    at = np.arange(len(a))
    equal = np.zeros(len(a), np.int32)
    for k, fewest in enumerate(least):
        batch = slice(k * BATCH, (k + 1) * BATCH)
        equal = equal + (left[a[at], batch] == right[b[at], batch]).sum(axis=1, dtype=np.int32)
        stays = equal >= fewest
        at, equal = at[stays], equal[stays]
        if not len(at):
            break
    return at


def _matrix(column: pa.Array, kind: type, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


def _column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def _bytes(texts: pa.Array) -> list[bytes]:
    return [(t or "").encode() for t in texts.to_pylist()]


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def row_key(key: str, text: str) -> Column:
    """A digest of key and text: rows that agree on both are interchangeable."""
    mark = F.when(F.col(text).isNull(), "null").otherwise("text")
    return F.unhex(F.md5(F.concat_ws(":", as_key(F.col(key)), mark, F.coalesce(F.col(text), F.lit("")))))


def sketch(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, row_key, n_shingles, same, signature`` of every row.

    ``same`` is a 128-bit digest of the shingle set, null for an empty set; so
    is the signature.
    """

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, hasher = Shingler(), MinHasher(SIZE)
        for rows in _slices(batches):
            sets = shingler.sets(_bytes(_column(rows, text)))
            digests = [
                np.array([s.sum(dtype=np.uint64), mixed(s).sum(dtype=np.uint64)]).tobytes() if len(s) else None for s in sets
            ]
            yield pa.RecordBatch.from_pydict(
                {
                    key: _column(rows, key),
                    "row_key": _column(rows, "row_key"),
                    "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                    "same": pa.array(digests, pa.binary()),
                    "signature": pa.array([hasher.signature(s).tobytes() if len(s) else None for s in sets], pa.binary()),
                }
            )

    fields = [docs.schema[key], *map(lambda n: T.StructField(n, T.BinaryType()), ("row_key", "same", "signature"))]
    schema = T.StructType([*fields[:2], T.StructField("n_shingles", T.LongType()), *fields[2:]])
    return docs.select(key, text, row_key(key, text).alias("row_key")).mapInArrow(sketched, schema)


def _memberships(nodes: DataFrame) -> DataFrame:
    """``bucket, node``: one row per band of each signature."""

    def banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _slices(batches, 4096):
            places = _matrix(_column(rows, "signature"), np.uint32, SIZE).reshape(-1, BANDS, ROWS).astype(np.uint64)
            buckets = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), places.shape[:2])
            for k in range(ROWS):
                buckets = mixed(buckets + places[:, :, k])
            node = np.repeat(_column(rows, "node").to_numpy(), BANDS)
            yield pa.RecordBatch.from_pydict({"bucket": buckets.ravel().view(np.int64), "node": node})

    return nodes.select("node", "signature").mapInArrow(banded, "bucket bigint, node bigint")


def _central(members: DataFrame, sizes: DataFrame) -> DataFrame:
    """``a, b``: each node with the most central node that is the most central of a bucket of its own.

    Central is a node that meets many others, counted over all its buckets: the
    text that copies were made from meets all copies, each copy fewer.
    """
    sized = members.join(sizes, "bucket")
    scores = sized.groupBy("node").agg(F.sum("size").alias("score"))
    scored = members.join(scores, "node")
    best = F.max(F.struct("score", "node"))
    tops = scored.groupBy("bucket").agg(best.alias("top"))
    return (
        members.join(tops, "bucket")
        .groupBy(F.col("node").alias("a"))
        .agg(F.max("top").alias("top"))
        .select("a", F.col("top.node").alias("b"))
        .where("a != b")
    )


def _with(pairs: DataFrame, nodes: DataFrame, column: str) -> DataFrame:
    """Pairs ``a, b`` with the nodes' column as ``left`` and ``right``."""
    for end, name in (("a", "left"), ("b", "right")):
        pairs = pairs.join(nodes.select(F.col("node").alias(end), F.col(column).alias(name)), end)
    return pairs


Kept = Callable[[list[bytes], np.ndarray, np.ndarray], np.ndarray]


def _stars(pairs: DataFrame, nodes: DataFrame, column: str, kept: Kept) -> DataFrame:
    """The pairs ``a, b`` that are kept by their nodes' ``column``, where many may share their ``b``.

    The pairs of a centre ``b`` are dealt into shares, and a share gets the
    centre's value once, ahead of the others; so no task takes a whole centre
    and no value is written into every pair.
    """
    dealt = pairs.withColumn("share", F.pmod(F.xxhash64("a"), F.lit(SHARES)))
    value = F.col(column).alias("value")
    centres = dealt.select("b", "share").distinct().join(nodes.select(F.col("node").alias("b"), value), "b")
    others = dealt.join(nodes.select(F.col("node").alias("a"), value), "a")
    columns = ("b", "share", "a", "value")
    together = others.select(*columns).unionByName(centres.withColumn("a", F.lit(None).cast("bigint")).select(*columns))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre: pa.RecordBatch | None = None
        for rows in _slices(batches, 1024):
            rows = rows if centre is None else pa.concat_batches([centre, rows])
            is_centre = _column(rows, "a").is_null().to_numpy(zero_copy_only=False)
            centre_of = np.maximum.accumulate(np.where(is_centre, np.arange(len(is_centre)), -1))
            centre = rows.slice(int(centre_of[-1]), 1)
            of = np.flatnonzero(~is_centre)
            found = pa.array(of[kept(_column(rows, "value").to_pylist(), of, centre_of[of])])
            yield pa.RecordBatch.from_pydict({c: _column(rows, c).take(found) for c in ("a", "b")})

    by = ("b", "share")
    dealt = together.repartition(*by).sortWithinPartitions(*by, F.col("a").asc_nulls_first())
    return dealt.mapInArrow(compare, "a bigint, b bigint")


def _by_signature(miss: float) -> Kept:
    least = least_matches(miss)

    def kept(values: list[bytes], left: np.ndarray, right: np.ndarray) -> np.ndarray:
        table = np.frombuffer(b"".join(values), np.uint32).reshape(-1, SIZE)
        return _surviving(table, table, left, right, least)

    return kept


def _by_set(values: list[bytes], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    sets = [np.frombuffer(v, np.uint64) for v in values]
    return np.flatnonzero([_similar(sets[i], sets[j]) for i, j in zip(left, right, strict=True)])


def _roots(links: DataFrame, workspace: Workspace) -> DataFrame:
    """``a, root`` for links ``a, b`` that form trees, each ``a`` below one ``b``: pointers doubled until they stand."""
    up = links.select("a", F.col("b").alias("root"))
    while True:
        counts = workspace.stage(up.groupBy("root").agg(F.count(F.lit(1)).alias("n")), "counts")
        total = counts.agg(F.sum("n")).first()[0] or 0
        over = up.select(F.col("a").alias("root"), F.col("root").alias("above"))
        found = spread_join(up, over, counts, "root", F.col("a"), total, "left")  # a root may be that of many
        found = workspace.stage(found.select("a", F.coalesce("above", "root").alias("root"), "above"), "roots")
        if found.where("above IS NOT NULL").isEmpty():
            return found.select("a", "root")
        up = found.select("a", "root")


def _groups(batches: Iterator[pa.RecordBatch], by: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    """Whole groups of a sorted stream; only one group and one slice are held at a time."""
    rest: pa.RecordBatch | None = None
    for batch in _slices(batches, 2048):
        rows = batch if rest is None else pa.concat_batches([rest, batch])
        keys = [_column(rows, c).to_numpy() for c in by]
        changes = np.any([np.diff(k) != 0 for k in keys], axis=0)
        cuts = [0, *(np.flatnonzero(changes) + 1)]
        for start, end in zip(cuts, cuts[1:], strict=False):
            yield rows.slice(start, end - start)
        rest = rows.slice(cuts[-1])  # the last group may go on in the next batch
    if rest is not None and rest.num_rows:
        yield rest


def _candidates(rows: pa.RecordBatch, open_pairs: np.ndarray | None, least: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs of a group's rows that survive: of different components, and those of ``open_pairs``."""
    component, size = (_column(rows, c).to_numpy() for c in ("component", "n_shingles"))
    signature = _matrix(_column(rows, "signature"), np.uint32, SIZE)
    a, b = np.triu_indices(rows.num_rows, 1)
    apart = component[a] != component[b]
    apart &= 4 * np.minimum(size[a], size[b]) >= 3 * np.maximum(size[a], size[b])  # else never similar enough
    if open_pairs is not None:
        apart &= open_pairs[a, b]
    a, b = a[apart], b[apart]
    kept = _surviving(signature, signature, a, b, least)
    return a[kept], b[kept]


def _pairs_of_buckets(members: DataFrame, known: DataFrame, miss: float) -> DataFrame:
    """Surviving pairs ``a, b`` within buckets of at most ``BLOCK`` nodes, with their components.

    ``members`` has ``bucket, node, component, cluster``; pairs within one
    cluster are left to ``_links_of_clusters``.
    """
    least = least_matches(miss)
    columns = ("bucket", "node", "component", "cluster", "n_shingles", "signature")
    grouped = members.join(known.select("node", "n_shingles", "signature"), "node").select(*columns)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches, ("bucket",)):
            node, cluster, component = (_column(rows, c).to_numpy() for c in ("node", "cluster", "component"))
            a, b = _candidates(rows, cluster[:, None] != cluster[None, :], least)
            a, b = np.where(node[a] < node[b], a, b), np.where(node[a] < node[b], b, a)
            ends = {"a": node[a], "b": node[b], "of_a": component[a], "of_b": component[b]}
            yield pa.RecordBatch.from_pydict(ends)

    ends = "a bigint, b bigint, of_a bigint, of_b bigint"
    return grouped.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(compare, ends).distinct()


def _links_of_clusters(clusters: DataFrame, known: DataFrame, sets: DataFrame, miss: float) -> DataFrame:
    """Components ``a, b`` of verified links within clusters, as many as it takes to join what is linked.

    ``clusters`` has ``cluster, node, component, blocks``. A cluster is
    compared as pairs of blocks, each pair a group of at most two blocks' rows
    in one task. Survivors are verified there, likeliest first, unless links
    found before have joined their components; so a group of n rows leaves
    less than n links, however many pairs are similar.
    """
    least = least_matches(miss)
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    others = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda o: F.struct(F.least(F.col("block"), o).alias("lo"), F.greatest(F.col("block"), o).alias("hi")),
    )
    by = ("cluster", "lo", "hi")
    grouped = (
        clusters.join(known.select("node", "n_shingles", "signature"), "node")
        .join(sets, "node")
        .withColumn("block", own)
        .withColumn("pair", F.explode(others))
        .select("cluster", "pair.lo", "pair.hi", "block", "component", "n_shingles", "signature", "hashes")
        .repartition(*by)
        .sortWithinPartitions(*by)
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches, by):
            component, block, lo, hi = (_column(rows, c).to_numpy() for c in ("component", "block", "lo", "hi"))
            across = (block[:, None] != block[None, :]) | (lo[0] == hi[0])
            a, b = _candidates(rows, across, least)
            signature = _matrix(_column(rows, "signature"), np.uint32, SIZE)
            order = np.argsort(-np.array([(signature[i] == signature[j]).sum() for i, j in zip(a, b, strict=True)]), kind="stable")
            hashes = [np.frombuffer(h, np.uint64) for h in _column(rows, "hashes").to_pylist()]
            joined = {int(c): int(c) for c in component}

            def root(c: int) -> int:
                while joined[c] != c:
                    joined[c] = c = joined[joined[c]]
                return c

            links = []
            for k in order:
                i, j = a[k], b[k]
                left, right = root(int(component[i])), root(int(component[j]))
                if left != right and _similar(hashes[i], hashes[j]):
                    joined[left] = right
                    links.append((component[i], component[j]))
            ends = np.array(links, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_pydict({"a": ends[:, 0], "b": ends[:, 1]})

    return grouped.mapInArrow(compare, "a bigint, b bigint")


def _similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two full sets are similar enough, by whole numbers."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= 75 * (len(a) + len(b) - both)


def _full_sets(docs: DataFrame, wanted: DataFrame, key: str, text: str) -> DataFrame:
    """``node, hashes``: the full shingle sets of the nodes in ``wanted``, from their texts."""
    keyed = docs.select(F.col(text).alias("_text"), row_key(key, text).alias("row_key"))
    chosen = wanted.join(keyed, "row_key").select("node", "_text")

    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for rows in _slices(batches):
            sets = shingler.sets(_bytes(_column(rows, "_text")))
            yield pa.RecordBatch.from_pydict({"node": _column(rows, "node"), "hashes": pa.array([s.tobytes() for s in sets], pa.binary())})

    found = chosen.mapInArrow(full, "node bigint, hashes binary")
    return found.groupBy("node").agg(F.first("hashes").alias("hashes"))  # rows that repeat have equal sets


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The components ``a, b`` of the pairs whose full sets are similar enough."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _slices(batches):
            ends = zip(_column(rows, "left").to_pylist(), _column(rows, "right").to_pylist(), strict=True)
            good = [_similar(np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)) for left, right in ends]
            mask = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_pydict({c: _column(rows, f"of_{c}").filter(mask) for c in ("a", "b")})

    return _with(pairs, sets, "hashes").mapInArrow(verify, "a bigint, b bigint")


def mark(docs: DataFrame, key: str = "doc_id", text: str = "text", miss: float = MISS) -> DataFrame:
    """Per row ``key, row_key, n_shingles, component_id, kept`` and the component's ``node``.

    Words are separated by white space, A-Z lower-cased; a shingle is five
    words, or all words of a shorter text. Rows whose sets have a Jaccard
    similarity of 0.75 or more are linked; ``component_id`` is the smallest
    key reachable. Null, empty and blank texts have no shingles and link with
    nothing: their component is their own key, their node null. Rows with a
    null key link like others but give no component id; a component without
    any key has a null id and keeps all its rows here (``survivors`` keeps
    one). Equal rows are both marked kept if one is. An empty table stays empty.
    """
    workspace = Workspace(docs.sparkSession)
    rows = workspace.stage(sketch(docs, key, text), "rows")
    sets_of = rows.where("same IS NOT NULL").groupBy("same", "n_shingles")
    nodes = sets_of.agg(F.min(key).alias("least"), F.min("row_key").alias("row_key"), F.first("signature").alias("signature"))
    nodes = workspace.stage(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")

    members = _memberships(nodes)
    sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    sizes = workspace.stage(sizes, "sizes")
    members = workspace.stage(members.join(sizes.select("bucket"), "bucket"), "members")
    met = members.select("node").distinct()
    sets = workspace.stage(_full_sets(docs, nodes.join(met, "node").select("node", "row_key"), key, text), "sets")
    known = workspace.stage(nodes.join(met, "node").select("node", "n_shingles", "signature"), "known")

    central = _stars(_central(members, sizes), known, "signature", _by_signature(miss))
    links = workspace.stage(_stars(workspace.stage(central, "central"), sets, "hashes", _by_set), "links")
    roots = _roots(links, workspace)
    found = roots.select(F.col("a").alias("node"), F.col("root").alias("component"))

    component = F.coalesce("component", "node")
    placed = members.join(found, "node", "left").select("bucket", "node", component.alias("component"))
    placed = workspace.stage(placed, "placed")
    opened = placed.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("size"),
        F.min("component").alias("lo"),
        F.max("component").alias("hi"),
        F.min("node").alias("first"),
    )
    opened = workspace.stage(opened.where("lo != hi").select("bucket", "size", "first"), "opened")
    large = placed.join(opened.where(F.col("size") > BLOCK), "bucket")
    large = workspace.stage(large.select(F.col("node").alias("a"), F.col("first").alias("b")), "large")
    clusters = components(large, workspace).withColumnRenamed("component", "cluster")
    clusters = workspace.stage(clusters, "clusters")
    small = placed.join(opened.where(F.col("size") <= BLOCK).select("bucket"), "bucket")
    small = small.join(clusters, "node", "left").withColumn("cluster", F.coalesce("cluster", -F.col("node") - 1))
    rest = workspace.stage(_pairs_of_buckets(small, known, miss), "rest")
    links = [_verified(rest, sets)]
    if not clusters.isEmpty():
        blocks = F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")
        within = clusters.join(clusters.groupBy("cluster").agg(blocks), "cluster").join(found, "node", "left")
        within = within.select("cluster", "node", component.alias("component"), "blocks")
        links.append(_links_of_clusters(within, known, sets, miss))
    links = workspace.stage(reduce(DataFrame.unionByName, links), "links")

    joined = workspace.stage(components(links, workspace), "components")
    rooted = nodes.join(found, "node", "left").select("same", component.alias("node"), "least")
    rooted = rooted.join(joined, "node", "left").select("same", component.alias("node"), "least")
    rooted = workspace.stage(rooted, "rooted")
    ids = rooted.groupBy("node").agg(F.min("least").alias("component_id"))
    ids = workspace.stage(rooted.join(ids, "node").select("same", "node", "component_id"), "ids")
    own = F.when(F.col("same").isNull(), F.col(key)).otherwise(F.col("component_id"))
    return (
        rows.select(key, "row_key", "n_shingles", "same")
        .join(ids, "same", "left")
        .withColumn("component_id", own)
        .withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))
        .drop("same")
    )


def survivors(docs: DataFrame, key: str = "doc_id", text: str = "text", miss: float = MISS) -> DataFrame:
    """One row of each group of near-duplicates, with the input's columns.

    The row of the smallest key stays (of rows without key, the smallest
    digest); of rows equal in key and text any one. Rows without shingles all
    stay.
    """
    workspace = Workspace(docs.sparkSession)
    marked = workspace.stage(mark(docs, key, text, miss), "marked")
    chosen = marked.where("node IS NOT NULL").groupBy("node")
    order = F.struct(F.col(key).isNull(), F.col(key), F.col("row_key"))
    chosen = chosen.agg(F.min(order).alias("best")).select(F.col("best.row_key").alias("_row_key"), F.lit(True).alias("_one"))
    empty = marked.where("node IS NULL").select(F.col("row_key").alias("_row_key"), F.lit(False).alias("_one")).distinct()
    stays = workspace.stage(chosen.unionByName(empty), "stays")
    columns = docs.columns
    kept = docs.withColumn("_row_key", row_key(key, text)).join(stays, "_row_key")
    repeated = marked.join(stays.where("_one"), F.col("row_key") == F.col("_row_key")).groupBy("row_key").count().where("count > 1")
    if not repeated.isEmpty():
        once = kept.where("_one").dropDuplicates(["_row_key"])
        kept = once.unionByName(kept.where("NOT _one"))
    return kept.select(*columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size, component and verdict of every document."""
    return mark(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


#: All pairs that share a shingle, and the smallest document reachable over links.
ORACLE = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM words),
one AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS shares
  FROM one a JOIN one b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared WHERE 100 * shares >= 75 * (na + nb - shares)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, r.c AS component_id, s.doc_id = r.c AS kept
FROM sets s JOIN (SELECT a, min(b) AS c FROM reach GROUP BY a) r ON s.doc_id = r.a
"""
