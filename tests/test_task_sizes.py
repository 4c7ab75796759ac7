"""Tasks grow in number, not in size, with the tables; totals meet without a join."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from weftline.operators import assembly, graph, pairs
from weftline.operators.features import FEATURES


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_shared_keys_deals_rows_by_their_number(spark, monkeypatch):
    rows = spark.createDataFrame([(k % 50, k % 17) for k in range(400)], "o long, s long")
    few = sorted(map(tuple, pairs.shared_keys(rows, "o", "s", 400).collect()))
    monkeypatch.setattr(pairs, "TASK_ROWS", 20)
    many = pairs.shared_keys(rows, "o", "s", 400)
    assert sorted(map(tuple, many.collect())) == few
    held = [set() for _ in range(50)]
    for k in range(400):
        held[k % 50].add((k, k % 17))
    want = Counter((a, b) for own in held for _, a in own for _, b in own if a < b)
    assert few == sorted((*p, n) for p, n in want.items())
    assert ", 40), REPARTITION_BY_NUM" in plan(many) and ", 20), REPARTITION_BY_NUM" in plan(many)
    assert pairs.task_count(spark, 81) == 5 and pairs.task_count(spark, 80) is None


def test_fold_enrichment_joins_no_totals(spark):
    p = spark.createDataFrame([("a", "b"), ("a", "b"), ("c", "d"), (None, "e")], "a string, b string")
    q = spark.createDataFrame([("a", "b"), ("x", "y"), (None, "e")], "a string, b string")
    out = graph.fold_enrichment(p, q, 10)
    assert "Join" not in plan(out)
    assert out.first().asDict() == pytest.approx({"n": 3, "k": 1, "known": 3, "fold": (1 / 3) / (3 / 100), "fp_rate": 2 / 3})
    assert graph.fold_enrichment(p.limit(0), q, 10).first().asDict() == {"n": 0, "k": 0, "known": 3, "fold": 0.0, "fp_rate": None}


def test_network_counts_in_one_pass(spark):
    links = [("s", "b", "a"), ("s", "a", "b"), ("s", "c", "c"), ("t", "a", "c"), ("t", "a", "d")]
    edges = spark.createDataFrame(links, "split string, a string, b string")
    out = graph.network_counts(edges, ["split"])
    assert "Join" not in plan(out)
    assert {r.split: (r.num_edges, r.num_nodes) for r in out.collect()} == {"s": (2, 3), "t": (2, 3)}
    own = graph.network_counts(edges.filter("split = 't'").select("a", "b"), once=True).first()
    assert (own.num_edges, own.num_nodes, [tuple(x) for x in own.degree_distribution]) == (2, 3, [(1, 2), (2, 1)])
    none = graph.network_counts(edges.select("a", "b").limit(0)).first()
    assert (none.num_edges, none.num_nodes) == (0, 0)


def test_degree_keys_sorted_by_tasks(spark, monkeypatch):
    monkeypatch.setattr(pairs, "TASK_ROWS", 10)
    ppi = spark.createDataFrame([(f"p{a}", f"p{b}", a) for a in range(12) for b in range(a + 1, 12) if (a * b) % 3], "protein_a string, protein_b string, score long")
    dealt = graph.ppi_degree_keys(ppi, ppi.count() * 2, once=True)
    rows = dealt.collect()
    assert rows == graph.ppi_degree_keys(ppi).collect() and rows == sorted(rows, key=lambda r: (-r.degree, r.protein_a, r.protein_b))
    assert "REPARTITION_BY_NUM" in plan(dealt)


def test_protein_distances_sum_sets_of_terms(spark):
    terms = [(f"p{k}", f"t{(k * k) % 5}") for k in range(30)] + [(f"p{k}", f"t{k % 4}") for k in range(0, 30, 3)] + [(None, "t1"), ("p1", None)]
    dist = {(a, b): abs(a - b) for a in range(5) for b in range(5) if abs(a - b) < 3}
    near = spark.createDataFrame([(f"t{a}", f"t{b}", n) for (a, b), n in dist.items()], "source string, node string, dist int")
    want = {}
    for p, t in terms:
        for q, u in terms:
            if p and q and t and u and p < q and (n := dist.get((int(t[1]), int(u[1])))) is not None:
                want[p, q] = min(n, want.get((p, q), 9))
    out = graph.protein_distances(spark.createDataFrame(terms, "uniprot_id string, go string"), near)
    assert sorted((r.p_i, r.p_j, r.dist) for r in out.collect()) == sorted((*k, n) for k, n in want.items())
    assert "keys=[p_i" not in plan(out)


def test_pairs_of_blocks_spread_over_tasks(spark):
    wide = spark.createDataFrame([("A", f"p{k}", [1.0, float(k)]) for k in range(200)] + [("B", "q", [2.0, 3.0])], "domain_id string, protein_id string, vec array<float>")
    out = assembly.block_pairs(spark.createDataFrame([("A", "A"), ("A", "B"), ("C", "A")], "domain_a string, domain_b string"), wide)
    assert out.count() == 200 * 200 + 200 and "REPARTITION_BY_NUM" in plan(out)
    rows = wide.withColumn("vec", F.when(F.col("protein_id") == "p3", F.array(F.lit(1.0), F.lit(float("nan"))).cast("array<float>")).otherwise(F.col("vec")))
    made = assembly.assemble(spark.createDataFrame([("A", "B", 1)], "domain_1 string, domain_2 string, interaction int"), rows.withColumn("feature", F.lit("f")), ["f"])
    assert made.count() == 2 * 199 and "isnan" not in plan(made).lower()  # looked at before pairs are made


def test_features_are_dealt_to_tasks(spark):
    table = spark.createDataFrame([(k % 5, k, "MKVA" * k) for k in range(9)], "domain_id int, protein_id int, domain_sequence string").coalesce(1)
    for name in ("aacomp", "aaencode", "dummy"):
        assert "REPARTITION_BY_NUM" in plan(FEATURES[name]({"domain_protein_map": table}))


def test_clustering_deals_open_paths(spark, monkeypatch):
    links = [(f"n{(k * k) % 23}", f"n{(k * 7) % 19}") for k in range(150)]
    edges = spark.createDataFrame([*links, *((b, a) for a, b in links[:40]), ("n1", "n1"), (None, "n2"), ("u", "v")], "a string, b string")
    near = {}
    for a, b in [*links, ("u", "v")]:
        if a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    want = {v: sum(b in near[a] for a in own for b in own) / (len(own) * (len(own) - 1)) if len(own) > 1 else 0.0 for v, own in near.items()}
    assert 0 < sum(want.values())
    assert {r.node: r.clustering for r in graph.clustering(edges).collect()} == pytest.approx(want)
    monkeypatch.setattr(pairs, "TASK_ROWS", 10)
    out = graph.clustering(edges)
    assert {r.node: r.clustering for r in out.collect()} == pytest.approx(want)
    assert plan(out).count("REPARTITION_BY_NUM") >= 4
    none = spark.createDataFrame([("x", "x")], "a string, b string")
    assert graph.clustering(none).count() == 0


def test_members_are_sent_for_tiles_not_for_pairs_of_domains(spark, monkeypatch):
    monkeypatch.setattr(assembly, "BUCKET", 5)
    monkeypatch.setattr(assembly, "PARTNERS", 2)
    rows = [("A" if k % 3 else f"D{k}", f"p{k}", float(k)) for k in range(40)]
    wide = spark.createDataFrame([*rows, (None, "q", 0.0)], "domain_id string, protein_id string, v double")
    given = sorted({("A", "A", 1), *(("A", f"D{k}", 0) for k in range(0, 40, 3)), ("D3", "A", 1), ("D3", "D6", 0), ("X", "A", 1), ("A", "Y", 1)})
    out = assembly.block_pairs(spark.createDataFrame(given, "domain_a string, domain_b string, label int"), wide)
    got = sorted((r.domain_a, r.domain_b, r.label, r.x.protein_id, r.x.v, r.y.protein_id, r.y.v) for r in out.collect())
    assert got == sorted((a, b, l, p, v, q, w) for a, b, l in given for d, p, v in rows if d == a for e, q, w in rows if e == b)
    plan = out._jdf.queryExecution().optimizedPlan().toString()  # both sides of the last join are dealt by tile
    assert plan.count("RepartitionByExpression [tile#") == 2, plan
