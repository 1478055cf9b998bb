import math
import random
import re

import pytest
from cases import SCHEMA, documents, frame, prose

from celltide.llm import quality
from celltide.sources.workspace import Workspace

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    places = {}
    for i in range(len(words) - 7):
        places.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {i + k for found in places.values() if len(found) > 1 for i in found for k in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
    )


def random_texts():
    r = random.Random(5)
    for _ in range(150):
        words = [r.choice("ab é x #| Z9".split(" ")) for _ in range(r.randrange(60))]
        yield "".join(w + r.choice([" ", "\n", "\t", "  ", "\x0b"]) for w in words)
    base = prose(9, 60)
    for k in range(20):
        yield base[: 20 * k] + " " + base + "\n" + base[7 * k :]


def test_base_counts_equal_brute_force(spark):
    rows = documents() + [(1000 + i, t, "en", "s", 1) for i, t in enumerate(random_texts())]
    got = quality.statistics(frame(spark, rows)).select("doc_id", "text", *quality.BASE).collect()
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r[2:]) == counts(r.text), r


def labelled_docs():
    docs, labels = [], []
    for i in range(300):
        clean = prose(i, 80 + i % 50)
        junk = i % 4 == 0
        docs.append((i, clean.replace(" ", "### ") if junk else clean, "en", "s", 1))
        labels.append((i, 0 if junk else 1, 0))
    return docs, labels


def test_learned_list_separates_held_out_rows(spark):
    docs, labels = labelled_docs()
    known = spark.createDataFrame(labels[:200] + [(7, None, None), (None, 0, 0), (5000, 0, 0)], "doc_id bigint, quality int, toxic int")
    rows = quality.judge(frame(spark, docs), known, Workspace(spark)).collect()
    assert len(rows) == 300
    held_out = {r.doc_id: r.kept for r in rows if r.doc_id >= 200}
    assert held_out == {i: i % 4 != 0 for i in range(200, 300)}
    assert all((r.rule is None) == r.kept for r in rows)


def test_learning_goes_on_after_a_rule_that_fails(spark):
    plain = dict.fromkeys(quality.GRIDS, 0.25)
    rows = [(plain, False, i % 3) for i in range(300)]
    # the most frequent kind is rejected in folds 0 and 1 and accepted in fold 2; another is not in fold 2 at all
    rows += [(plain | {"symbol_share": 0.65}, i % 3 < 2, i % 3) for i in range(90)]
    rows += [(plain | {"bang_share": 0.65}, True, i % 2) for i in range(30)]
    rows += [(plain | {"digit_share": 0.65}, True, i % 3) for i in range(24)]
    frame = spark.createDataFrame([(*r.values(), reject, fold) for r, reject, fold in rows], [*quality.GRIDS, "reject", "fold"])
    rules = quality.learn(frame.cache())
    assert [t.feature for rule in rules for t in rule] == ["digit_share"]


@pytest.mark.parametrize("rows", [330, 3000])
def test_labels_without_a_pattern_end_the_learning(spark, monkeypatch, rows):
    r = random.Random(rows)
    plain = [({name: r.choice(grid) for name, grid in quality.GRIDS.items()}, r.random() < 0.1, i % 3) for i in range(rows)]
    frame = spark.createDataFrame([(*v.values(), reject, fold) for v, reject, fold in plain], [*quality.GRIDS, "reject", "fold"])
    scans = []
    before = quality._binned_counts
    monkeypatch.setattr(quality, "_binned_counts", lambda df: scans.append(1) or before(df))
    assert quality.learn(frame.cache()) == []
    assert len(scans) <= 8


def test_a_small_kind_is_found_among_many_rows(spark):
    r = random.Random(3)
    low = {name: grid[len(grid) // 2] for name, grid in quality.GRIDS.items()}
    rows = [(low | {"digit_share": 0.25 * r.random()}, False, i % 3) for i in range(3000)]
    rows += [(low | {"digit_share": 0.65}, True, i % 3) for i in range(18)]
    frame = spark.createDataFrame([(*v.values(), reject, fold) for v, reject, fold in rows], [*quality.GRIDS, "reject", "fold"])
    assert [t.feature for rule in quality.learn(frame.cache()) for t in rule] == ["digit_share"]


def test_evidence_is_that_of_a_two_by_two_table():
    assert quality.evidence(10, 90, 100, 900) == pytest.approx(0)
    assert quality.evidence(20, 0, 20, 380) == pytest.approx(2 * (20 * math.log(20) + 380 * math.log(400 / 380)))


def test_edge_cases_have_a_verdict(spark):
    docs = frame(spark).withColumnsRenamed({"lang": "N_Words", "source": "kept"})
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    rows = quality.judge(docs, labels, Workspace(spark)).collect()
    assert len(rows) == len(documents())
    assert all(r.kept == (not r.base_failed) for r in rows)
    for r in rows:
        n, *_, repeated = counts(r.text)
        assert r.base_failed == (n < 20 or 100 * repeated > 30 * n)


@pytest.mark.parametrize("labels", [[], [(1, 1, 0)]])
def test_empty_table(spark, labels):
    known = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    assert quality.judge(spark.createDataFrame([], SCHEMA), known, Workspace(spark)).collect() == []
