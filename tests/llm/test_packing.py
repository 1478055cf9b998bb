import os
import random
import zlib
from bisect import insort

import cases
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from celltide.llm import packing
from celltide.llm.vocab import SPECIAL, ByteVocabulary
from celltide.sources.workspace import Workspace

os.environ["TOKENIZERS_PARALLELISM"] = "false"
SCHEMA = "item bigint, length bigint"


@pytest.fixture(scope="module")
def vocabulary():
    return ByteVocabulary(special=SPECIAL)


def sequences_by_decreasing_best_fit(lengths, capacity):
    gaps, n = [], 0
    for length in sorted(lengths, reverse=True):
        at = next((i for i, g in enumerate(gaps) if g >= length), None)
        gap = gaps.pop(at) if at is not None else capacity
        n += at is None
        insort(gaps, gap - length)
    return n


def check(rows, capacity):
    """Rows of sequence, offset, length: full to their ends, without holes; the number of sequences."""
    of: dict[int, list] = {}
    for sequence, offset, length in rows:
        of.setdefault(sequence, []).append((offset, length))
    for pieces in of.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return len(of)


def placed(spark, lengths, capacity):
    pieces = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], SCHEMA)
    found = packing.best_fit(pieces, Workspace(spark), capacity).collect()
    assert sorted(r["item"] for r in found) == list(range(len(lengths)))
    return check([(r.sequence, r.offset, lengths[r["item"]]) for r in found], capacity)


def test_ids_are_those_of_the_tokenizer(vocabulary):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [r[1] or "" for r in cases.documents()]
    texts += ["a <|endoftext|> b", "<|endoftext|><|endoftext|>", "<|endoftext|", "tabs\t\tand\r\n \n", "\x00\x01", "’s 'll ٣ ⅷ ﬁ"]
    for text in texts:
        assert vocabulary.encode(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_documents_are_cut_with_the_short_piece_first():
    assert packing.cut_lengths(1, 4) == [1]
    assert packing.cut_lengths(4, 4) == [4]
    assert packing.cut_lengths(9, 4) == [1, 4, 4]


def test_every_document_is_packed(spark, vocabulary):
    rows = cases.documents()
    docs = cases.frame(spark, rows).withColumns({"ids": F.lit(1), "piece": F.lit("x"), "item": F.lit(2), "sequence_id": F.lit(3)})
    packed = packing.pack(docs, vocabulary)
    assert packed.columns == ["doc_id", "piece", "start", "length", "ids", "sequence_id", "offset"]
    found = packed.collect()
    check([(r.sequence_id, r.offset, r.length) for r in found], packing.CAPACITY)
    expected = []
    for key, text, *_ in rows:
        ids = [*vocabulary.encode(text or "").tolist(), packing.END]
        first = len(ids) % packing.CAPACITY or packing.CAPACITY
        starts = [0, *range(first, len(ids), packing.CAPACITY)]
        for k, (lo, hi) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
            expected.append((key, k, lo, hi - lo, np.array(ids[lo:hi], "<u4").tobytes()))
    assert sorted(map(str, expected)) == sorted(str((r.doc_id, r.piece, r.start, r.length, bytes(r.ids))) for r in found)


def test_sequences_join_their_pieces(spark, vocabulary):
    packed = packing.pack(cases.frame(spark), vocabulary, capacity=64).cache()
    whole = {r.sequence_id: bytes(r.ids) for r in packing.sequences(packed).collect()}
    rows = packed.collect()
    assert set(whole) == {r.sequence_id for r in rows}
    for r in rows:
        assert whole[r.sequence_id][4 * r.offset : 4 * (r.offset + r.length)] == bytes(r.ids)
    assert sum(map(len, whole.values())) == 4 * sum(r.length for r in rows)


def test_checksums_of_the_query_are_of_little_endian_ids(spark, vocabulary):
    packed = packing.pack(cases.frame(spark, [(1, "some text", "en", "s", 9)]), vocabulary, payload=F.crc32("ids"))
    ids = np.array([*vocabulary.encode("some text"), packing.END], "<u4")
    assert packed.first()["_payload"] == zlib.crc32(ids.tobytes())


def test_an_empty_table_gives_no_rows(spark, vocabulary):
    assert packing.pack(cases.frame(spark, []), vocabulary).collect() == []


@pytest.mark.parametrize("kind", ["long tail", "uniform", "tiny", "one hot length", "all alike", "over half", "whole"])
def test_about_as_few_sequences_as_decreasing_best_fit(spark, kind):
    r = random.Random(5)
    lengths = {
        "long tail": [min(2047, int(r.lognormvariate(6, 1)) + 1) for _ in range(1500)],
        "uniform": [r.randint(1, 2047) for _ in range(1000)],
        "tiny": [r.randint(1, 20) for _ in range(2000)],
        "one hot length": [683] * 400 + [min(2047, int(r.lognormvariate(6, 1)) + 1) for _ in range(800)],
        "all alike": [500] * 1001,
        "over half": [1025] * 300,
        "whole": [2048] * 20,
    }[kind]
    n, least = placed(spark, lengths, 2048), sequences_by_decreasing_best_fit(lengths, 2048)
    assert n <= least * 1.005 + 1


def test_a_sweep_over_ranges_matches_as_one_stack_would(spark, workspace):
    r = random.Random(3)
    places = [(packing._PLACE, r.randint(1, 60), None, i, 0) for i in range(300)]
    pieces = [(packing._PIECE, r.randint(1, 60), i, None, None) for i in range(280)]
    free, expected = [], set()
    for kind, size, item, sequence, _ in sorted(places + pieces, key=lambda e: (-e[1], e[0], e[2] or 0, e[3] or 0)):
        if kind == packing._PLACE:
            free.append(sequence)
        elif free:
            expected.add((item, free.pop()))
    swept = packing._sweep(spark.createDataFrame(places + pieces, packing._EVENTS), workspace, 580)
    found = swept.where(F.col("kind") == packing._PAIR).collect()
    assert {(e["item"], e.sequence) for e in found} == expected
    rest = swept.where(F.col("kind") == packing._PIECE).count()
    assert rest == 280 - len(expected)


def test_no_more_slots_are_offered_than_pieces_need():
    # two pieces, a thousand wide gaps: one slot each of the narrowest that holds the longest
    assert packing._slots({100: 1000, 2000: 1000}, {10: 2}, 10) == (100, 1)
    assert packing._slots({100: 1}, {10: 20}, 10) == (100, 10)
