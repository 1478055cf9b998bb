import hashlib
import os
from collections import Counter

import cases
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from celltide.llm import alignment
from celltide.llm.vocab import ByteVocabulary

os.environ["TOKENIZERS_PARALLELISM"] = "false"
ODD = [
    "a▁b", "▁", " leading", "\x00nul", "<s>x</s><|endoftext|>", "<0x41>", "\U0001f600\U0001f3fd é é", "ﬁ ² Ⅷ", " ", "\n\n\t x ",
    "日本語のテキスト", "x" * 3000, "aaaa bbbb" * 300,
]


@pytest.fixture(scope="module")
def aligner():
    return alignment.Aligner(ByteVocabulary(), alignment.PieceVocabulary())


@pytest.fixture(scope="module")
def rows():
    return cases.documents() + [(200 + i, t, "xx", "odd", len(t)) for i, t in enumerate(ODD)]


@pytest.fixture(scope="module")
def brute(rows):
    """Groups of each row, as the two libraries give them."""
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    bytes_a = ByteVocabulary().token_bytes()

    def ends(ids, size):
        return np.cumsum([size(i) for i in ids]).tolist()

    def of_b(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    found = []
    for _, text, *_ in rows:
        ids_a, ids_b = (a.encode(f" {text}", add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        data = f" {text}".encode()
        if not text or b"".join(bytes_a[i] for i in ids_a) != data or b"".join(map(of_b, ids_b)) != data:
            found.append([])
            continue
        ends_a, ends_b = ends(ids_a, lambda i: len(bytes_a[i])), ends(ids_b, lambda i: len(of_b(i)))
        groups, at_a, at_b = [], 0, 0
        for cut in sorted(set(ends_a) & set(ends_b)):
            to_a, to_b = ends_a.index(cut, at_a) + 1, ends_b.index(cut, at_b) + 1
            groups.append((ids_a[at_a:to_a], ids_b[at_b:to_b]))
            at_a, at_b = to_a, to_b
        found.append(groups)
    return found


def test_agreement_with_the_libraries(spark, aligner, rows, brute):
    links = [[(a[-1], b[-1]) for a, b in groups] for groups in brute]
    count = Counter(link for of in links for link in of)
    most = Counter()
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    expected = []
    for (key, *_), groups, of in zip(rows, brute, links, strict=True):
        written = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        n_a, n_b = (sum(len(g[side]) for g in groups) for side in (0, 1))
        best, total = sum(count[x] == most[x[1]] for x in of), sum(count[x] for x in of)
        sha = hashlib.sha256(written.encode()).hexdigest() if groups else ""
        expected.append((key, n_a, n_b, len(groups), len(of), best, total, sha))
    docs = cases.frame(spark, rows).withColumns({"chunk": F.lit("x"), "n_a": F.lit(1), "codes": F.lit(None).cast("string")})
    found = alignment.agreement(docs.repartition(5), aligner)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(str(tuple(r)) for r in found.collect()) == sorted(map(str, expected))
    assert [e for e in expected if e[0] == 200][0][1:] == (0, 0, 0, 0, 0, 0, "")  # U+2581 reads back as a space


def test_small_chunks_give_the_same(spark, aligner, rows, monkeypatch):
    docs = cases.frame(spark, rows)
    once = sorted(str(tuple(r)) for r in alignment.agreement(docs, aligner).collect())
    monkeypatch.setattr(alignment, "CHUNK_DOCS", 3)
    monkeypatch.setattr(alignment, "CHUNK_LINKS", 40)
    assert sorted(str(tuple(r)) for r in alignment.agreement(docs, aligner).collect()) == once


def test_groups_are_real_ids(spark, aligner, rows, brute):
    found = alignment.groups(cases.frame(spark, rows).withColumn("groups", F.lit(1)), aligner)
    got = sorted(str((r.doc_id, r.text, [(g.a, g.b) for g in r.groups])) for r in found.collect())
    assert got == sorted(str((r[0], r[1], g)) for r, g in zip(rows, brute, strict=True))


def test_an_empty_table_gives_no_rows(spark, aligner):
    assert alignment.agreement(cases.frame(spark, []), aligner).collect() == []
    assert alignment.agreement(cases.frame(spark, [(1, None, None, None, None)]), aligner).collect()[0].n_groups == 0


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(1, 400)), st.sets(st.integers(1, 400)), st.sets(st.integers(1, 400)))
def test_halving_finds_every_common_end(left, right, both):
    a, b = (np.array(sorted(side | both | {401})) for side in (left, right))
    zero = np.zeros(1, np.int64)
    at_a, at_b = alignment.shared_cuts(a, b, zero, zero + len(a) - 1, zero, zero + len(b) - 1)
    common = np.intersect1d(a, b)
    assert a[at_a].tolist() == common.tolist() == b[at_b].tolist()


def test_a_long_interval_without_cuts_is_one_leaf():
    a, b = np.append(np.arange(1, 200_001, 2), 200_002), np.append(np.arange(2, 200_001, 2), 200_002)
    zero = np.zeros(1, np.int64)
    at_a, at_b = alignment.shared_cuts(a, b, zero, zero + len(a) - 1, zero, zero + len(b) - 1)
    assert (at_a.tolist(), at_b.tolist()) == ([len(a) - 1], [len(b) - 1])


def test_the_cut_nearest_to_the_middle_is_taken():
    a = np.arange(1, 101)
    b = np.array([10, 45, 90, 100])
    at_a, at_b = alignment._near_middle(a, b, np.array([0]), np.array([99]))
    assert (a[at_a[0]], b[at_b[0]]) == (45, 45)
