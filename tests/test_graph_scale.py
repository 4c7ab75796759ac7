"""Rounds and results of graph algorithms on graphs that are long, hot or odd."""

import numpy as np
import pytest

from weftline.operators import graph
from weftline.plans.workloads import components


def union_find(pairs, nodes=()):
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    return {x: find(x) for x in [*up, *nodes]}


@pytest.fixture
def rounds(monkeypatch):
    """Counts the rounds of contraction."""
    seen, written = [], graph.Tables.written

    def noted(self, df, name):
        if name.startswith("map-"):
            seen.append(name)
        return written(self, df, name)

    monkeypatch.setattr(graph.Tables, "written", noted)
    return seen


def test_shuffled_path(spark, rounds):
    n = 16_000
    order = np.random.default_rng(5).permutation(n).tolist()
    got = graph.connected_components(spark.createDataFrame(list(zip(order, order[1:])), "a long, b long")).collect()
    assert len(got) == n and {r.component for r in got} == {0}
    assert len(rounds) <= 15


def test_sf01_query(spark, rounds):
    got = {r.node: r.component for r in components(spark, "/root/testdata/sf0.1").collect()}
    keys = [r[0] for r in spark.read.parquet("/root/testdata/sf0.1/customer.parquet").select("c_custkey").collect()]
    assert got == union_find([(k, k * 3 % (max(keys) + 1)) for k in keys])
    assert len(rounds) <= 15


def test_star_ring_and_odd_rows(spark, rounds):
    star = [(7, k) for k in range(100, 3000)]
    ring = [(5000 + k, 5000 + (k + 1) % 50) for k in range(50)]
    odd = [(1, 1), (None, 3), (4, None), (2, 9), (9, 2), (2, 9)]
    got = {r.node: r.component for r in graph.connected_components(spark.createDataFrame(star + ring + odd, "a long, b long"), spark.createDataFrame([(9,), (77_777,), (None,)], "n long")).collect()}
    assert got == union_find([p for p in star + ring + odd if None not in p], [77_777])
    none = graph.connected_components(spark.createDataFrame([], "a string, b string"))
    assert none.columns == ["node", "component"] and none.count() == 0


@pytest.mark.parametrize("seed", range(2))
def test_random_graphs(spark, seed):
    draw = np.random.default_rng(seed)
    pairs = [(f"n{a}", f"n{b}") for a, b in draw.integers(0, 400, (260, 2)).tolist()]
    got = {r.node: r.component for r in graph.connected_components(spark.createDataFrame(pairs, "a string, b string")).collect()}
    assert got == union_find(pairs)
