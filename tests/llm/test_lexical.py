import math
import random
import re
from collections import Counter

import cases
import numpy as np
import pytest

from celltide.llm import lexical

ITEMS = "item_id bigint, text string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(_LOWER))


def brute(docs, items, top=10):
    words = [terms(text) for _, text, *_ in docs]
    n_docs, n_words = sum(map(bool, words)), sum(map(len, words))
    df = Counter(w for ws in words for w in set(ws))
    found = []
    for item, text in items:
        scored = []
        for (key, *_), ws in zip(docs, words, strict=True):
            if not ws:
                continue
            tf, m = Counter(ws), 100 - 90 + (90 * len(ws) * n_docs) // n_words
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 8 * m))
                for t in set(terms(text))
                if tf[t]
            )
            if score > 0:
                scored.append((-score, key is None, key or 0, key))
        found += [(item, r, key, -score) for r, (score, _, _, key) in enumerate(sorted(scored, key=lambda x: x[:3])[:top], 1)]
    return sorted(map(str, found))


def searched(spark, docs, items, **options):
    items = spark.createDataFrame(items, ITEMS)
    found = lexical.search(cases.frame(spark, docs), items, **options)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(str(tuple(r)) for r in found.collect())


def corpus(n, seed=1):
    r = random.Random(seed)
    lexicon = [f"w{i}" for i in range(300)]
    draw = lambda: lexicon[min(299, int(r.expovariate(0.02)))]
    docs = [(i, " ".join(draw() for _ in range(r.choice([3, 20, 80]))), "en", "s", 0) for i in range(n)]
    copies = [(n + i, docs[7][1], "en", "s", 0) for i in range(n // 3)]  # a third of all rows are one text
    items = [(i, " ".join(draw() for _ in range(r.randint(1, 25)))) for i in range(40)]
    return docs + copies, items


def test_terms_are_maximal_matches_in_whole_texts():
    odd = [r[1] for r in cases.documents()] + ["A-b_c9 É÷x\x7fy\x80z", "x" * 100 + " y"]
    for text in odd:
        assert [w.decode() for part in lexical.words(text) for w in part] == terms(text)


def test_long_texts_are_read_in_parts(monkeypatch):
    monkeypatch.setattr(lexical, "_SEGMENT", 50)
    text = cases.prose(3, 400) + "long" * 100
    parts = list(lexical.words(text))
    assert len(parts) > 10
    assert [w.decode() for part in parts for w in part] == terms(text)


def test_odd_rows(spark):
    items = [(1, cases.prose(1)), (2, None), (3, ""), (None, "naïve 123４５"), (4, "...,"), (5, "nowhere-to-be-found qqq"), (1, cases.prose(1)), (6, "a b c a")]
    assert searched(spark, cases.documents(), items) == brute(cases.documents(), items)


@pytest.mark.parametrize("options", [{}, {"block_items": 7}, {"block_terms": 20}, {"top": 3}])
def test_best_rows_of_a_corpus_with_a_hot_text(spark, options):
    docs, items = corpus(500)
    assert searched(spark, docs, items, **options) == brute(docs, items, options.get("top", 10))


def test_small_buckets_are_pruned_and_give_the_same(spark, monkeypatch):
    docs, items = corpus(400, seed=2)
    monkeypatch.setattr(lexical, "BUCKET", 16)
    assert searched(spark, docs, items) == brute(docs, items)


def test_bounds_drop_buckets_without_a_result():
    import pyarrow as pa

    weight = np.array([5, 3, 1], np.int64)
    rows = pa.RecordBatch.from_pydict(
        {
            "key": pa.array([1, 2], pa.int64()),
            "terms": [np.array([0, 1], "<i4").tobytes(), np.array([2], "<i4").tobytes()],
            "adds": [np.array([50, 30], "<i8").tobytes(), np.array([10], "<i8").tobytes()],
            "norm": [math.hypot(50, 30), 10.0],
        }
    )
    queries = [np.array([0, 1]), np.array([2]), np.array([0, 2])]
    state = lexical._Search(queries, weight, np.array([1, 60, 51]), 10)
    state.bucket(rows)
    assert state.best == [[(-80, False, 1)], [], []]  # the second falls to Cauchy and Schwarz, the third to whole scores


def test_empty_tables(spark):
    assert searched(spark, [], [(1, "a")]) == []
    assert searched(spark, cases.documents(), []) == []
    assert searched(spark, [(1, None, None, None, None), (2, " ", None, None, None)], [(1, "a")]) == []


def test_other_columns_may_have_any_names(spark):
    docs = cases.frame(spark, [(1, "red fox", "en", "s", 7), (2, "blue fox", "en", "s", 8)])
    docs = docs.withColumnsRenamed({"lang": "score", "source": "rank", "n_chars": "query"}).withColumnRenamed("query", "item_id")
    found = lexical.search(docs, spark.createDataFrame([(5, "Red")], ITEMS))
    assert [(r.item_id, r["rank"], r.doc_id) for r in found.collect()] == [(5, 1, 1)]
