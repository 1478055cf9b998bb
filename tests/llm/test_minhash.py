import random
import re

import numpy as np
import pytest
from cases import LONG, SCHEMA, documents, frame, prose

from celltide.llm import minhash
from celltide.llm.shingles import MinHasher, Shingler
from test_components import brute

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lowered)
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def linked(a, b):
    both = len(a & b)
    return both and 100 * both >= 75 * (len(a) + len(b) - both)


def expected(rows):
    """By position: set size and smallest key reachable."""
    sets = [shingles(r[1]) for r in rows]
    edges = [(i, j) for i in range(len(rows)) for j in range(i) if linked(sets[i], sets[j])]
    root = brute(edges)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least.setdefault(root.get(i, i), []).append(r[0])
    return [(len(s), min(least.get(root.get(i, i), []), default=None)) for i, s in enumerate(sets)]


def near_copies():
    """Families around texts of many lengths, copies near and below the threshold, chains, shared passages."""
    r = random.Random(6)
    rows, passage = [], prose(500, 70)
    for family in range(14):
        base = prose(family, r.choice([8, 30, 60, 150, 400])).split()
        for _ in range(r.randrange(2, 9)):
            words = list(base)
            for _ in range(int(len(words) * r.choice([0, 0.01, 0.03, 0.05, 0.08]))):
                words[r.randrange(len(words))] = f"new{r.randrange(10**6)}"
            rows.append(" ".join(words) if r.random() < 0.8 else "  ".join(words).upper())
    rows += [passage + " " + prose(600 + i, 50) for i in range(12)]
    chain = prose(900, 100).split()
    for i in range(10):
        rows.append(" ".join(chain[6 * i :] + [f"tail{k}" for k in range(6 * i)]))
    r.shuffle(rows)
    return [(1000 + 3 * i, t, "en", "s", len(t)) for i, t in enumerate(rows)]


def test_regular_words_hash_apart():
    """Thue-Morse words and their complements, which polynomials modulo a power of two confuse, among other regular ones."""
    words = []
    for k in range(6, 14):
        bits = [bin(i).count("1") % 2 for i in range(1 << k)]
        words += ["".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)]
    words += ["ab" * n for n in range(1, 40)] + ["a" * n for n in range(1, 80)] + ["x" * 8 + "y" * 8, "y" * 8 + "x" * 8]
    hashes = [Shingler().sets([w.encode()])[0][0] for w in words]
    assert len(set(hashes)) == len(set(words))
    assert len(Shingler().sets([" ".join(words[8:10] + ["c d e f g"]).encode()])[0]) == 3


def test_hashed_sets_equal_sets_of_words():
    texts = [t or "" for _, t, *_ in documents() + near_copies()]
    found = Shingler().sets([t.encode() for t in texts])
    assert [len(s) for s in found] == [len(shingles(t)) for t in texts]
    for i in range(0, len(texts), 3):
        for j in range(0, i, 5):
            assert len(np.intersect1d(found[i], found[j])) == len(shingles(texts[i]) & shingles(texts[j]))


def test_long_texts_are_hashed_in_segments(monkeypatch):
    whole = Shingler().sets([LONG.encode(), b"x" * 5000 + b" " + LONG.encode()])
    monkeypatch.setattr("celltide.llm.shingles._SEGMENT", 1000)
    parts = Shingler().sets([LONG.encode(), b"x" * 5000 + b" " + LONG.encode()])
    assert all(np.array_equal(a, b) for a, b in zip(whole, parts, strict=True))


def test_signatures_estimate_similarity():
    r, hasher = np.random.default_rng(1), MinHasher(minhash.SIZE)
    for share in (0.2, 0.5, 0.75, 0.9):
        both = int(1000 * share)
        a = r.integers(0, 1 << 63, 1000, dtype=np.uint64)
        b = np.concatenate([a[:both], r.integers(0, 1 << 63, 1000 - both, dtype=np.uint64)])
        equal = (hasher.signature(a) == hasher.signature(b)).mean()
        assert equal == pytest.approx(both / (2000 - both), abs=0.12)


def test_few_matches_needed_after_each_batch():
    least = minhash.least_matches()
    assert list(least) == sorted(least) and least[0] < 0.75 * minhash.BATCH
    # pairs at the threshold are hardly ever dropped
    r = np.random.default_rng(3)
    equal = (r.random((100_000, minhash.SIZE)) < 0.75).cumsum(axis=1)
    dropped = np.zeros(100_000, bool)
    for k, fewest in enumerate(least):
        dropped |= equal[:, (k + 1) * minhash.BATCH - 1] < fewest
    assert dropped.mean() <= 6 * minhash.MISS + 1e-4


@pytest.mark.parametrize("block", [256, 3])
def test_components_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    rows = documents() + near_copies()
    got = minhash.mark(frame(spark, rows)).collect()
    want = sorted(((r[0], n, c) for r, (n, c) in zip(rows, expected(rows), strict=True)), key=str)
    # a row without shingles has its own key; one without key reaches the smallest key of its group
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_blocks_alone_find_all_links(spark, monkeypatch):
    """Without the comparison with central nodes, the blocks still find every link."""
    real = minhash._central
    monkeypatch.setattr(minhash, "_central", lambda members, sizes: real(members, sizes).where("false"))
    rows = near_copies()
    got = {r.doc_id: r.component_id for r in minhash.mark(frame(spark, rows)).collect()}
    assert got == {r[0]: c for r, (_, c) in zip(rows, expected(rows), strict=True)}


def test_one_row_of_each_group_survives(spark):
    rows = documents() + near_copies()
    docs = frame(spark, rows).withColumnRenamed("lang", "NODE")
    kept = minhash.survivors(docs).collect()
    assert kept[0].__fields__ == docs.columns
    sets = [shingles(r[1]) for r in rows]
    root = brute([(i, j) for i in range(len(rows)) for j in range(i) if linked(sets[i], sets[j])])
    groups = {root.get(i, i) for i, s in enumerate(sets) if s}
    assert sum(1 for r in kept if shingles(r.text)) == len(groups)
    assert sum(1 for r in kept if not shingles(r.text)) == sum(1 for s in sets if not s)
    want = {c for r, (n, c) in zip(rows, expected(rows), strict=True) if n and c is not None}
    assert {r.doc_id for r in kept if shingles(r.text) and r.doc_id is not None} == want


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert minhash.mark(empty).collect() == [] and minhash.survivors(empty).collect() == []
