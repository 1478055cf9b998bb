import hashlib
import math

import pytest
from cases import SCHEMA, documents, frame

from celltide.llm import sharding


def unit(*parts):
    digest = hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()
    return (int(digest[:13], 16) + 0.5) / 2**52


def best(key, weights):
    return min((-math.log(unit("null" if key is None else key, s)) / w, s) for s, w in enumerate(weights))[1]


def check(rows, weights):
    for r in rows:
        assert r.shard == best(r.doc_id, weights)
        assert r.grown_shard == best(r.doc_id, [*weights, 1.0])
        assert r.grown_shard in (r.shard, len(weights))
    for shard in range(len(weights)):
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))


def many(n):
    return [(i * 7, f"t{i % 50}", "en", "s", 1) for i in range(n)]


@pytest.mark.parametrize("rows_per_part", [5000, 3])
def test_shards_and_slots(spark, rows_per_part):
    weights = [1.0] * 7 + [3.0]
    rows = sharding.place(frame(spark, many(800)), weights=weights, rows_per_part=rows_per_part).collect()
    assert len(rows) == 800
    check(rows, weights)
    heavy = sum(r.shard == 7 for r in rows)
    assert 0.22 < heavy / 800 < 0.38  # 3 of 10
    moved = sum(r.shard != r.grown_shard for r in rows)
    assert 0.05 < moved / 800 < 0.14  # 1 of 11


def test_slots_do_not_depend_on_the_parts(spark):
    slots = [
        {r.doc_id: r.slot for r in sharding.place(frame(spark, many(300)), weights=[1.0] * 4, rows_per_part=n).collect()}
        for n in (5000, 5)
    ]
    assert slots[0] == slots[1]


def test_a_key_with_most_rows_is_split(spark):
    rows = many(100) + [(5, "same", "en", "s", 1)] * 700 + [(None, None, None, None, None)] * 90
    placed = sharding.place(frame(spark, rows), weights=[1.0] * 3, rows_per_part=10).collect()
    assert len(placed) == len(rows)
    check(placed, [1.0] * 3)


def test_edge_cases(spark):
    df = frame(spark).withColumnsRenamed({"lang": "Shard", "source": "_part"})
    rows = sharding.place(df).collect()
    assert len(rows) == len(documents())
    check(rows, [1.0] * sharding.SHARDS)
    assert sharding.place(spark.createDataFrame([], SCHEMA)).collect() == []
    for weights in ([], [1.0, 0.0], [-1.0], [float("nan")], [float("inf")]):
        with pytest.raises(ValueError):
            sharding.place(df, weights=weights)
