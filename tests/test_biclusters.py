"""Biclusters of many terms against a plain recursion over sets, and against every block of ones."""

import itertools

import numpy as np
import pytest

from weftline.operators import graph

DENSE = 0.6


def recursion(m, rows, cols, out, seen, dense=DENSE):
    """The search over index sets, without rounds or masks."""
    if len(rows) < 3 or len(cols) < 3 or (rows, cols) in seen:
        return
    seen.add((rows, cols))
    part = m[np.ix_(rows, cols)]
    if (part.mean(0) > dense).all() and (part.mean(1) > dense).all():
        out.add((rows, cols))
        return
    gaps = [k for k in range(len(rows)) if not part[k].all()]
    if not gaps:
        return
    k = min(gaps, key=lambda k: (part[k].sum(), k))
    inside = tuple(c for c, x in zip(cols, part[k]) if x)
    lacks = [c for c in cols if c not in inside]
    recursion(m, tuple(r for r in rows if m[r, lacks].any()), cols, out, seen, dense)
    recursion(m, tuple(r for r in rows if m[r, inside].any()) if inside else (), inside, out, seen, dense)


@pytest.fixture(scope="module")
def graphs():
    draw = np.random.default_rng(5)
    out = {}
    for k in range(12):
        m = draw.random((12, 12)) < (0.3, 0.5, 0.7)[k % 3]
        m |= m.T
        out[f"t{k:02d}"] = m
    return out


@pytest.fixture(scope="module")
def wanted(graphs):
    out = set()
    for go, m in graphs.items():
        own = tuple(np.flatnonzero(m.any(0)).tolist())
        found = set()
        recursion(m, own, own, found, set())
        out |= {(go, r, c) for r, c in found}
    return out


def table(spark, graphs):
    rows = [(go, f"n{a:02d}", f"n{b:02d}") for go, m in graphs.items() for a, b in np.argwhere(m).tolist()]
    return spark.createDataFrame(rows + rows[:5] + [("t00", None, "n01"), (None, "n00", "n01")], "go string, a string, b string")


@pytest.mark.parametrize("looks, shared", [(200_000, 20_000), (3, 2)])
def test_equals_a_plain_recursion(spark, graphs, wanted, monkeypatch, looks, shared):
    monkeypatch.setattr(graph, "LOOKS", looks)
    monkeypatch.setattr(graph, "SHARED", shared)
    got = [(r.go, tuple(int(x[1:]) for x in r.rows), tuple(int(x[1:]) for x in r.cols)) for r in graph.biclusters(table(spark, graphs), DENSE).collect()]
    assert len(got) == len(set(got)) and set(got) == wanted and len(wanted) > 40


def test_pairs_hold_every_block_of_ones(spark, graphs, wanted):
    got = {(r.go, int(r.a[1:]), int(r.b[1:])) for r in graph.bicluster_pairs(table(spark, graphs), DENSE).collect()}
    assert got == {(go, a, b) for go, r, c in wanted for a in r for b in c}
    for go, m in graphs.items():
        for rows in itertools.combinations(range(12), 3):
            cols = np.flatnonzero(m[list(rows)].all(0)).tolist()
            assert len(cols) < 3 or {(go, a, b) for a in rows for b in cols} <= got


def test_lone_nodes_and_nothing(spark):
    rows = spark.createDataFrame([("t", "x", "x"), ("u", "x", "y"), ("v", None, "y")], "go string, a string, b string")
    assert [tuple(r) for r in graph.bicluster_pairs(rows, DENSE).collect()] == [("t", "x", "x")]
    assert graph.bicluster_pairs(rows.limit(0), DENSE).count() == 0
