import random

import pytest

from celltide.llm.components import components


def brute(edges):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    return {x: root(x) for x in parent}


def random_edges():
    r = random.Random(2)
    return [(r.randrange(400), r.randrange(400)) for _ in range(330)]


PATH = [(i, i + 1) for i in range(60)]
CASES = {
    "none": [],
    "loops and nulls": [(3, 3), (None, 4), (5, None), (None, None)],
    "star": [(0, i) for i in range(1, 300)] + [(999, i) for i in range(500, 700)],
    "path": [(b * 37 % 61, a * 37 % 61) for a, b in PATH],
    "random": random_edges() * 2,
    "negative": [(-5, 7), (7, -9)],
}


@pytest.mark.parametrize("name", CASES)
def test_components_equal_union_find(spark, workspace, name):
    edges = CASES[name]
    got = components(spark.createDataFrame(edges, "a bigint, b bigint"), workspace).collect()
    assert {r.node: r.component for r in got} == brute(edges)
    assert len(got) == len(brute(edges))
