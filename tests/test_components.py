import random

import pytest

from kinweave.operators.components import connected_components, hub_edges


def union_find(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(parent) if find(x) != x}


def run(spark, edges, **options):
    df = spark.createDataFrame([(max(a, b), min(a, b)) for a, b in edges if a != b], "u long, v long")
    return {r.node: r.root for r in connected_components(df, **options).collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_random_graph(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)]
    edges = [(a, b) for a, b in edges if a != b]
    assert run(spark, edges, min_hot_rows=10) == union_find(edges)


def test_long_path(spark):
    edges = [(i, i + 1) for i in range(1000)]
    assert run(spark, edges, max_rounds=15) == {i: 0 for i in range(1, 1001)}


def test_hot_key_makes_a_star(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"k{i % 50}") for i in range(600)]
    df = spark.createDataFrame(rows, "seq long, key string")
    edges = hub_edges(df, ["key"], "seq", min_hot_rows=50)
    assert edges.count() < len(rows)
    first = {}
    pairs = [(i, first.setdefault(k, i)) for i, k in rows]
    got = {r.node: r.root for r in connected_components(edges, min_hot_rows=50).collect()}
    assert got == union_find([(a, b) for a, b in pairs if a != b])


def test_no_edges(spark):
    assert run(spark, []) == {}
