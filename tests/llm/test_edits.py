import hashlib
import random

import numpy as np
import pytest
from cases import SCHEMA, documents, frame, prose
from pyspark.sql import functions as F

from celltide.llm import bpe, edits


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.read_ranks())


def spliced(text, at, removed, inserted):
    at = min(max(at, 0), len(text))
    return text[:at] + inserted + text[at + max(removed, 0) :]


def check(tree, text, codec):
    assert tree.n_tokens == len(codec.encode(text))
    leaves = slice(tree.width, tree.width + tree.leaves)
    assert tree.chars[1] == len(text) == tree.chars[leaves].sum()
    assert tree.tokens[leaves].sum() == tree.n_tokens
    for i in range(1, tree.width):
        assert tree.chars[i] == tree.chars[2 * i] + tree.chars[2 * i + 1]
        assert tree.tokens[i] == tree.tokens[2 * i] + tree.tokens[2 * i + 1]


@pytest.mark.parametrize("run", [1, 3, 32])
def test_counts_after_random_edits_equal_a_recount(codec, monkeypatch, run):
    monkeypatch.setattr(edits, "RUN", run)
    r = random.Random(run)
    parts = [" ", "  ", "\n", "'", "'s", "'re", "re", "ve", "the", " the", "12", " 3", "é", "日本", "!!", " !", "\U0001f600", "\t", "​", "L", "l"]
    for _ in range(60):
        text = "".join(r.choice(parts) for _ in range(r.randrange(120)))
        tree = edits.build_tree(text, codec)
        check(tree, text, codec)
        for _ in range(25):
            at, removed = r.randrange(-2, len(text) + 3), r.choice([0, 0, 1, 2, 7, 40, 1000])
            inserted = "".join(r.choice(parts) for _ in range(r.choice([0, 1, 1, 2, 3, 60])))
            want = spliced(text, at, removed, inserted)
            text, tree, _ = edits.edit(text, tree, at, removed, inserted, codec)
            assert text == want
            check(tree, text, codec)


def test_a_small_edit_encodes_a_small_region(codec):
    text = prose(1, 20_000)
    tree = edits.build_tree(text, codec)
    for at in (0, 1000, len(text) // 2, len(text) - 3):
        _, changed, encoded = edits.edit(text, edits.Tree.stored(tree.leaves, tree.chars, tree.tokens), at, 5, "new words", codec)
        assert encoded <= 4 * edits.RUN
        assert changed.leaves == tree.leaves


def test_columns(spark, codec):
    changes = [(3, 2, "xyz"), (0, 0, " a'"), (10**6, 5, "end"), (None, 1, "no"), (2, None, None), (5, 10**9, None)]
    docs = frame(spark).withColumnRenamed("lang", "N_tokens").withColumnRenamed("source", "n_encoded")
    docs = docs.withColumn("edits", F.lit(None).cast(edits.EDITS))
    some = spark.createDataFrame([(900, prose(5), changes[:3]), (901, prose(6), changes), (902, None, changes[:1]), (903, None, [None])],
                                 f"doc_id bigint, text string, edits {edits.EDITS}")
    got = edits.apply_edits(edits.count_tokens(docs.unionByName(some, allowMissingColumns=True), codec), codec).collect()
    assert len(got) == len(documents()) + 4
    by_id = {r.doc_id: r for r in got}
    for r in got:
        assert r.n_tokens == len(codec.encode(r.text))
        check(edits.Tree.stored(r.tree_leaves, np.array(r.tree_chars), np.array(r.tree_tokens)), r.text or "", codec)
    want = prose(6)
    for at, removed, inserted in changes:
        want = want if at is None else spliced(want, at, removed or 0, inserted or "")
    assert by_id[901].text == want
    assert by_id[902].text == "xyz" and by_id[903].text is None and by_id[0].text is None and by_id[0].n_encoded == 0


def test_query_on_derived_edits_equals_a_recount(spark, codec, tmp_path):
    frame(spark).write.parquet(str(tmp_path / "documents.parquet"))
    got = {str(r.doc_id) + r.text_sha256: r for r in edits.query(spark, str(tmp_path)).collect()}
    rows = edits.derived_edits(frame(spark)).collect()
    for row in rows:
        text = row.text or ""
        before = len(codec.encode(text))
        for e in row.edits:
            text = spliced(text, e.at, e.removed, e.inserted)
        r = got[str(row.doc_id) + hashlib.sha256(text.encode()).hexdigest()]
        assert (r.tokens_before, r.tokens_after) == (before, len(codec.encode(text)))


def test_empty_table(spark, codec):
    empty = edits.derived_edits(spark.createDataFrame([], SCHEMA))
    assert edits.apply_edits(edits.count_tokens(empty, codec), codec).collect() == []
