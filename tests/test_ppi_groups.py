"""Components of similar interactions without their pairs, and counts without a row for each domain pair of an interaction."""

import itertools
import random

import pytest

from weftline.operators import graph

TERMS = [("t0", "t1"), ("t1", "t2"), ("t3", "t4")]


def plain(edges, kinds, near):
    """Components by looking at every pair."""

    def close(p, q):
        return p != q and any((s, t) in near for s in kinds.get(p, ()) for t in kinds.get(q, ()))

    name = {e: e for e in edges}
    for (a, b), (c, d) in itertools.combinations(sorted(edges), 2):
        if (close(a, c) and close(b, d)) or (close(b, c) and close(a, d)):
            one, two = sorted((name[a, b], name[c, d]))
            name = {e: one if n == two else n for e, n in name.items()}
    return {frozenset(e for e in edges if name[e] == n) for n in set(name.values())}


def drawn(k):
    """Networks with stars, two lines, single kinds and dense tables."""
    draw = random.Random(k)
    n, terms = draw.randint(4, 16), draw.choice([1, 2, 4, 6])
    kinds = {f"p{i:02d}": {f"t{draw.randrange(terms)}" for _ in range(draw.choice([1, 1, 2]))} for i in range(n)}
    names = sorted(kinds)
    hubs = draw.sample(names, draw.choice([0, 1, 2]))
    edges = {tuple(sorted((h, p))) for h in hubs for p in names if draw.random() < 0.8} | {tuple(sorted(draw.choices(names, k=2))) for _ in range(draw.choice([0, 2, 4, 12]))}
    return edges, kinds


@pytest.mark.parametrize("most", [0, 1])
def test_ppi_groups_are_the_components(spark, most):
    """Forty networks in one table: each has terms of its own, so they don't meet."""
    nets = [drawn(100 * most + k) for k in range(40)]
    hops = {(a, b): 1 for x in TERMS for a, b in (x, x[::-1])} | {(f"t{k}", f"t{k}"): 0 for k in range(6)}
    near = {p for p, n in hops.items() if n <= most}
    edges = [(f"{i}-{a}", f"{i}-{b}") for i, (own, _) in enumerate(nets) for a, b in own]
    terms = [(f"{i}-{p}", f"{i}-{t}") for i, (_, kinds) in enumerate(nets) for p, ts in kinds.items() for t in ts]
    dist = [(f"{i}-{a}", f"{i}-{b}", n) for i in range(len(nets)) for (a, b), n in hops.items()]
    ppi = spark.createDataFrame([*edges, *(e[::-1] for e in edges[:3]), ("lone", "x")], "protein_a string, protein_b string")
    out = graph.ppi_groups(ppi, spark.createDataFrame(terms, "uniprot_id string, go string"), spark.createDataFrame(dist, "source string, node string, dist int"), most)
    got = {}
    for r in out.collect():
        got.setdefault(r.group_name, []).append((r.protein_a, r.protein_b))
    assert all(len(set(v)) == len(v) for v in got.values())
    want = {frozenset((f"{i}-{a}", f"{i}-{b}") for a, b in part) for i, (own, kinds) in enumerate(nets) for part in plain(own, kinds, near)} | {frozenset([("lone", "x")])}
    assert {frozenset(v) for v in got.values()} == want
    assert len({len(v) for v in got.values()}) > 4


def test_links_do_not_grow_with_pairs(spark, monkeypatch):
    """300 interactions of one kind have 44,850 pairs, nearly all of them similar."""
    seen = []
    real = graph.connected_components
    monkeypatch.setattr(graph, "connected_components", lambda links, nodes: seen.append(links.count()) or real(links, nodes))
    names = [f"p{k:03d}" for k in range(40)]
    edges = random.Random(3).sample(list(itertools.combinations(names, 2)), 300)
    out = graph.ppi_groups(spark.createDataFrame(edges, "protein_a string, protein_b string"), spark.createDataFrame([(p, "t") for p in names], "uniprot_id string, go string"), spark.createDataFrame([("t", "t", 0)], "source string, node string, dist int"), 0)
    assert out.select("group_name").distinct().count() == 1 and seen[0] <= 600


def test_chi_square_of_overlapping_groups(spark):
    draw = random.Random(4)
    pd = {(f"p{k}", f"D{draw.randrange(4)}") for k in range(7) for _ in range(3)} - {("p6", f"D{k}") for k in range(4)}
    groups = {(f"g{draw.randrange(3)}", f"p{draw.randrange(7)}", f"p{draw.randrange(7)}") for _ in range(30)}
    own = {}
    for g, a, b in groups:
        own.setdefault(g, set()).add(tuple(sorted((a, b))))
    every = set().union(*own.values())
    shown = {e: {tuple(sorted((x, y))) for p, x in pd for q, y in pd if (p, q) == e} for e in every}
    want = {}
    for g, inside in own.items():
        for pair in set().union(*(shown[e] for e in inside)):
            a, t = sum(pair in shown[e] for e in inside), sum(pair in shown[e] for e in every)
            want[g, *pair] = (a, t)
    rows = graph.group_chi_square(spark.createDataFrame(sorted(groups), "group_name string, protein_a string, protein_b string"), spark.createDataFrame(sorted(pd), "uniprot_id string, pfam_id string"))
    got = {(r.group_name, r.d1, r.d2): (r.a, r.chi2) for r in rows.collect()}
    assert got.keys() == want.keys()
    for (g, *pair), (a, t) in want.items():
        b, c = t - a, len(own[g]) - a
        d = len(every) - len(own[g]) - b
        den = (a + c) * (b + d) * (a + b) * (c + d)
        assert got[g, *pair] == (a, pytest.approx((a + b + c + d) * (a * d - b * c) ** 2 / den if den else 0.0))


def test_similar_by_terms_equals_all_pairs_and_makes_nothing_distinct(spark, monkeypatch):
    draw = random.Random(9)
    ppi = [(f"p{draw.randrange(14)}", f"p{draw.randrange(14)}") for _ in range(60)]
    terms = [(f"p{k}", f"t{draw.randrange(4)}") for k in range(12) for _ in range(2)]  # two proteins without terms
    near = [(f"t{a}", f"t{b}", abs(a - b)) for a in range(4) for b in range(4)]
    given, own = spark.createDataFrame(ppi, "protein_a string, protein_b string"), spark.createDataFrame(terms, "uniprot_id string, go string")
    distances = spark.createDataFrame(near, "source string, node string, dist int")
    monkeypatch.setattr(graph, "CELL", 2)
    for most in (0, 1):
        close = {(a, b) for a, s in terms for b, t in terms if a != b and abs(int(s[1]) - int(t[1])) <= most}
        edges = sorted({(min(e), max(e)) for e in ppi})
        want = sorted((*e, *f) for e in edges for f in edges if e < f and any((x, f[0]) in close and (y, f[1]) in close for x, y in (e, e[::-1])))
        out = graph.similar_by_terms(given, own, distances, most)
        assert sorted(map(tuple, out.collect())) == want and want
        assert not {"Distinct", "Aggregate"} & set(out._jdf.queryExecution().optimizedPlan().toString().replace("(", " ").split())
