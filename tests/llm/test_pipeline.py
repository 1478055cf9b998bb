import os
import shutil
import subprocess
import sys
from collections import Counter

import public_tokenizers
import pytest
import tiktoken
from cases import documents, frame, prose
from pyspark.sql import functions as F
from test_minhash import expected, shingles
from test_mixing import copies
from test_quality_rules import counts
from test_secrets import base

import corpus_pipeline
from celltide.llm import bpe, registry

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def corpus():
    """Clean prose, junk, copies and near copies, secrets, and the odd documents."""
    rows = []
    for i in range(240):
        text = prose(i, 60 + i % 90)
        if i % 5 == 0:
            text = text.replace(" ", "### ")
        elif i % 7 == 0:
            text = prose(i - i % 7 + 1, 80).replace("the", "thee", 1)
        elif i % 11 == 0:
            text += f" password: hunter{i:08d}"
        rows.append((i, text, "en", f"src{i % 3 if i % 2 else 0}", len(text)))
    return rows + [(10_000 + i, *r[1:]) for i, r in enumerate(documents()) if r[1] != documents()[9][1]]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("corpus")
    frame(spark, corpus()).write.parquet(str(path / "documents.parquet"))
    labels = [(i, int(i % 5 != 0), 0) for i in range(200)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(str(path / "labels.parquet"))
    return str(path)


def masked(text):
    out, at = "", 0
    for start, _, end in base(text):
        if start >= at:
            out += text[at:start] + "[SECRET]"
        at = max(at, end)
    return out + text[at:]


def test_every_stage_equals_brute_force(spark, folder, workspace):
    rows = corpus()
    encoding = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(bpe.read_ranks())}, special_tokens={}
    )

    def good(row):
        n, *_, repeated = counts(row[1])
        return n >= 20 and 100 * repeated <= 30 * n and "###" not in row[1] and "#*$" not in row[1]

    rows = [r for r in rows if good(r)]
    rows = [r for r, (n, c) in zip(rows, expected(rows), strict=True) if not n or r[0] == c]
    rows = list({(r[0], shingles(r[1]) and 1): r for r in rows}.values())
    rows = [(r[0], masked(r[1]), r[2], r[3], len(masked(r[1])) if base(r[1]) else r[4]) for r in rows]

    docs, seen = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = workspace.stage(stage(spark, docs, folder), name)
        seen.append(docs)
    plain = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert plain(seen[2]) == sorted(rows, key=str)

    size = Counter()
    for r in rows:
        size[r[3]] += len(r[1].encode())
    rate = {s: sum(size.values()) / len(size) / n for s, n in size.items()}
    mixture = [r for r in rows for _ in range(copies(r[0], rate[r[3]]))]
    assert plain(seen[3]) == sorted(mixture, key=str)
    ids = [(r[0], r[3], len(x := encoding.encode_ordinary(r[1])), x) for r in mixture]
    assert plain(seen[4]) == sorted(ids, key=str)
    assert plain(corpus_pipeline.run(spark, folder)) == sorted(ids, key=str)


def test_stages_keep_the_columns_of_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").withColumn("Kept", F.lit(1)).withColumn("spans", F.lit("x"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).columns == docs.columns


def test_empty_documents(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("false")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    shutil.copytree(f"{folder}/labels.parquet", tmp_path / "labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_every_operator_is_registered_once():
    numbers = [int(name[2:].split("_")[0]) for name in registry.QUERIES]
    assert sorted(numbers) == list(range(1, 14))
    assert set(registry.ORACLES) <= set(registry.QUERIES)


def test_library_stands_without_these_operators(tmp_path):
    shutil.copytree(ROOT, tmp_path / "repo", ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as e; assert e.queries() and not any(n.startswith('op1') or n == 'pipeline' for n in e.queries()); assert e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", check=True, env=os.environ | {"PYTHONPATH": ""})
