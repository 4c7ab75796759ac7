"""The graph predictors' values end to end against a plain model in sets and dictionaries."""

import itertools

import numpy as np
import pytest
from test_biclusters import recursion

from weftline.operators import graph_models as G
from weftline.operators import nullmodels
from weftline.operators.pairs import reduce_for_graph

ONTOLOGY = [("r", "a", 1), ("r", "b", 1), ("a", "c", 2), ("a", "d", 2), ("b", "e", 2), ("b", "f", 2), ("c", "g", 3)]


def drawn(seed):
    """ddi, pd, ppi and go of a split; some rows of each are dropped by the cascade."""
    draw = np.random.default_rng(seed)
    proteins = [f"p{k:02d}" for k in range(18)]
    pd = {(p, f"D{d}") for p in proteins for d in draw.choice(9, 2, replace=False)} | {("stray", "D77")}
    ppi = {(a, b, 950 if draw.random() < 0.8 else 400) for a, b in itertools.combinations(proteins, 2) if draw.random() < 0.45} | {("p00", "nogo", 999), ("p03", "p01", 960)}
    go = {(p, "abcdefgr"[k]) for p in proteins for k in draw.choice(8, 2, replace=False)} | {("p01", "elsewhere"), ("stray", "a")}
    ddi = {(f"D{a}", f"D{b}", int(draw.random() < 0.4), int(draw.random() < 0.8)) for a in range(9) for b in range(a, 9)} | {("D0", "D77", 1, 1), ("D1", "D1", 1, 0)}
    return ddi, pd, ppi, go


def tables(spark, split):
    ddi, pd, ppi, go = (sorted(x) for x in split)
    return G.Split(
        spark.createDataFrame(ddi, "domain_a string, domain_b string, interaction int, eval_relevant int"), spark.createDataFrame(pd, "uniprot_id string, pfam_id string"),
        spark.createDataFrame(ppi, "protein_a string, protein_b string, score int"), spark.createDataFrame(go, "uniprot_id string, go string"),
    )


def hops(threshold):
    near = {}
    for a, b, _ in ONTOLOGY:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    out = {}
    for s in near:
        seen, edge = {s: 0}, {s}
        for k in range(1, threshold + 1):
            edge = {w for v in edge for w in near[v]} - set(seen)
            seen |= dict.fromkeys(edge, k)
        out[s] = set(seen)
    return out


def prepared(split, threshold):
    ddi, pd, ppi, go = split
    ppi = {(a, b) for a, b, score in ppi if score > 900}
    terms = {t for a, b, _ in ONTOLOGY for t in (a, b)}
    go = {(p, t) for p, t in go if t in terms and any(p in e for e in ppi)}
    with_go = {p for p, _ in go}
    ppi = {tuple(sorted(e)) for e in ppi if set(e) <= with_go}
    pd = {(p, d) for p, d in pd if any(p in e for e in ppi)}
    own = {}
    for p, d in pd:
        own.setdefault(p, set()).add(d)
    domains = {d for _, d in pd}
    ddi = {x for x in ddi if x[0] in domains and x[1] in domains}
    level = {}
    for _, t, depth in ONTOLOGY:
        level[t] = min(depth, level.get(t, depth))
    most = {p: max(level.get(t, np.inf) for q, t in go if q == p) for p in with_go}
    specific = {(p, t) for p, t in go if level.get(t, np.inf) == most[p]}
    reach = hops(threshold)
    mine = {p: {t for q, t in specific if q == p} for p in with_go}
    close = {(p, q) for p, q in itertools.permutations(with_go, 2) if any(u in reach[t] for t in mine[p] for u in mine[q])}
    name = {e: e for e in ppi}
    for (a, b), (c, d) in itertools.combinations(sorted(ppi), 2):
        if {(a, c), (b, d)} <= close or {(b, c), (a, d)} <= close:
            one, two = sorted((name[(a, b)], name[(c, d)]))
            name = {e: one if n == two else n for e, n in name.items()}
    shown = {e: {tuple(sorted((x, y))) for x in own.get(e[0], ()) for y in own.get(e[1], ())} for e in ppi}
    chi2 = {}
    for group in set(name.values()):
        inside = [e for e in ppi if name[e] == group]
        for pair in {x for e in inside for x in shown[e]}:
            a = sum(pair in shown[e] for e in inside)
            b = sum(pair in shown[e] for e in ppi) - a
            c = len(inside) - a
            d = len(ppi) - len(inside) - b
            den = (a + c) * (b + d) * (a + b) * (c + d)
            chi2.setdefault(group, {})[pair] = float(a + b + c + d) * float(a * d - c * b) ** 2 / float(den) if den else 0.0
    lists = {}
    for t in {t for _, t in specific}:
        ps = {p for p, u in specific if u == t}
        d1 = {d for p in ps for d in own.get(p, ())}
        d2 = {d for e in ppi for p, q in (e, e[::-1]) if p in ps for d in own.get(q, ())}
        if d1 and d2:
            lists[t] = (d1, d2)
    return ddi, chi2, lists, len(domains)


def expanded(ready, at, dense):
    _, chi2, lists, _ = ready
    best = []
    for scores in chi2.values():
        v = sorted(scores.values())
        spot = at * (len(v) - 1)
        lo, hi = v[int(np.floor(spot))], v[int(np.ceil(spot))]
        limit = v[0] if at <= 0 else v[-1] if at >= 1 else lo if lo == hi else (1 - (spot - np.floor(spot))) * lo + (spot - np.floor(spot)) * hi
        best += [(p, x) for p, x in scores.items() if x >= limit]
    edges = {p for p, _ in best} | {p[::-1] for p, _ in best}
    pairs = set()
    for d1, d2 in lists.values():
        links = {(a, b) for a, b in edges if a in d1 and b in d2}
        nodes = sorted({x for e in links for x in e})
        m = np.array([[(a, b) in links or (b, a) in links for b in nodes] for a in nodes], bool).reshape(len(nodes), len(nodes))
        found, every = set(), tuple(range(len(nodes)))
        recursion(m, every, every, found, set(), dense)
        pairs |= {(nodes[a], nodes[b]) for r, c in found for a in r for b in c}
        if len(nodes) == 1:
            pairs.add((nodes[0], nodes[0]))
    return best, pairs


def fold(ready, pairs):
    known = {(a, b) for a, b, label, _ in ready[0] if label == 1}
    k = len(pairs & known)
    return k / len(pairs) / (len(known) / ready[3] ** 2) if pairs and known else 0.0


def predicted(ready, at, dense):
    best, pairs = expanded(ready, at, dense)
    score = {}
    for p, x in best:
        score[p] = max(x, score.get(p, 0.0))
    top = max(score.values())
    out = {}
    for a, b in {(a, b) for a, b, _, relevant in ready[0] if relevant}:
        label = max(y for c, d, y, relevant in ready[0] if (c, d) == (a, b) and relevant)
        out[(a, b)] = (label, int((a, b) in pairs or (b, a) in pairs), score.get((a, b), 0.0) / top if top else 0.0)
    return out


@pytest.fixture(scope="module")
def ontology(spark):
    return spark.createDataFrame([(a, b, k, k) for a, b, k in ONTOLOGY], "parent string, child string, level int, depth int")


@pytest.mark.parametrize("seed, threshold", [(1, 1)])
def test_network_model(spark, ontology, seed, threshold):
    train, test = drawn(seed), drawn(seed + 100)
    config = G.NetworkConfig(chi_square_cutoffs=[0.5, 0.2], bicluster_cutoffs=[0.5, 0.7], threshold=threshold)
    ready = prepared(train, threshold)
    folds = [(fold(ready, expanded(ready, x, b)[1]), x, b) for x in config.chi_square_cutoffs for b in config.bicluster_cutoffs]
    want = max(folds, key=lambda f: f[0])[1:]  # the first of equals
    out, chosen = G.network_model(tables(spark, train), tables(spark, test), ontology, config)
    assert chosen == want and len({f[0] for f in folds}) > 1
    got = {(r.domain_a, r.domain_b): (r.true_interaction, r.predicted_interaction, r.predicted_probability) for r in out.collect()}
    plain = predicted(prepared(test, threshold), *want)
    assert got.keys() == plain.keys() and len(got) > 20
    for k, (label, hit, score) in plain.items():
        assert got[k][:2] == (label, hit) and got[k][2] == pytest.approx(score, abs=1e-6)
    assert len({x[1] for x in plain.values()}) == 2 and len({round(x[2], 6) for x in plain.values()}) > 3


def test_parsimony_model(spark):
    """Covers and rewirings have tests of their own; what the model makes of them is worked out plainly here."""
    split = drawn(5)
    config = G.ParsimonyConfig(reliabilities=[0.5, 1.0], cutoffs=[0.1, 0.3, 0.6], iterations=20, runs=4)
    given = tables(spark, split)
    kept = reduce_for_graph(given.ddi, given.pd, given.ppi, None, None)
    pairs = sorted({(a, b) for a, b, _, _ in map(tuple, kept["ddi"].select("domain_a", "domain_b", "interaction", "eval_relevant").collect())})
    labels = {p: (max(y for a, b, y, _ in split[0] if (a, b) == p), max(e for a, b, _, e in split[0] if (a, b) == p)) for p in pairs}
    number = spark.createDataFrame([(k, *p) for k, p in enumerate(pairs)], "pair_id long, domain_a string, domain_b string")
    ppi, pd = kept["ppi"].select("protein_a", "protein_b").distinct(), kept["pd"].select("uniprot_id", "pfam_id").distinct()
    own = {}
    for p, d in map(tuple, pd.collect()):
        own.setdefault(p, set()).add(d)
    seen = {p: sum(p[0] in own.get(a, ()) and p[1] in own.get(b, ()) for a, b in map(tuple, ppi.collect())) for p in pairs}
    drawn_x = {(r.iter, r.pair_id): r.x for r in nullmodels.random_covers(ppi, pd, number, config.iterations, config.seed).collect()}
    x = {(r.reliability, r.pair_id): r.x for r in nullmodels.observed_cover(ppi, pd, number, config.reliabilities, config.runs, config.seed).collect()}
    pw = {}
    for (r, k), v in x.items():
        p = sum(drawn_x.get((i, k), 0.0) >= v for i in range(config.iterations)) / config.iterations
        pw[r, pairs[k]] = min(p, (1 - r) ** seen[pairs[k]])
    grid = []
    for r in config.reliabilities:
        for c in config.cutoffs:
            hit = {p: int(pw[r, p] <= c) for p in pairs}
            grid.append((-np.mean([hit[p] == labels[p][0] for p in pairs]), np.mean([hit[p] == 1 and labels[p][0] == 0 for p in pairs]), r, c))
    best = min(min((g for g in grid if g[2] == r), key=lambda g: (g[0], g[1], g[3])) for r in config.reliabilities)
    out, chosen = G.parsimony_model(given, given, config)
    assert chosen == best[2:]
    got = {(r.domain_a, r.domain_b): (r.true_interaction, r.predicted_interaction, r.predicted_probability) for r in out.collect()}
    assert got.keys() == {p for p in pairs if labels[p][1]} and len(got) > 20
    for p, (label, hit, score) in got.items():
        assert (label, hit) == (labels[p][0], int(pw[chosen[0], p] <= chosen[1])) and score == pytest.approx(1 - pw[chosen[0], p], abs=1e-6)
