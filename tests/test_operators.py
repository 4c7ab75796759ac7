import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftline.functions import scalars as X
from weftline.functions import sequences as S
from weftline.operators import assembly, catalog, evaluation, graph, pairs, report


def test_composition_and_triads(spark):
    df = spark.createDataFrame([(1, "AAXc"), (2, "XX"), (3, ""), (4, None), (5, "AßC1G"), (6, "AGVCCFK")], "k int, s string")
    rows = {r.k: r for r in df.select("k", S.composition(F.col("s")).alias("v"), S.reduced_alphabet(F.col("s")).alias("r"), S.conjoint_triad(F.col("s")).alias("t")).collect()}
    assert rows[1].v[0] == pytest.approx(2 / 3) and rows[1].v[1] == pytest.approx(1 / 3) and rows[2].v is rows[3].v is rows[4].v is None
    assert rows[5].r == "0 1 0" and rows[6].r == "0001125" and sum(rows[6].t) == 5 and rows[6].t[0] == 1 and rows[6].t[1 * 49 + 1 * 7 + 2] == 1
    long = {(r.k, r.triad): r.n for r in S.triad_counts(df, ["k"], "s").collect()}
    assert long == {(6, 0): 1, (6, 1): 1, (6, 8): 1, (6, 58): 1, (6, 1 * 49 + 2 * 7 + 5): 1}
    whole = df.filter("s IS NOT NULL")
    assert {r.k: r.v for r in S.triad_vectors(df, ["k"], "s").collect()} == {r.k: r.t for r in whole.select("k", S.conjoint_triad(F.col("s")).alias("t")).collect()}
    v = spark.sql("SELECT array(1d, 3d, 5d) AS v, array(0d, 0d) AS z").select(S.normalised(F.col("v")).alias("v"), S.normalised(F.col("z")).alias("z")).first()
    assert v.v == [0.0, 0.4, 0.8] and v.z == [0.0, 0.0]


def test_estate_and_pair_descriptor(spark):
    table = spark.createDataFrame([("A", 1.0, 2.0, 4.0), ("C", 0.0, 1.0, 5.0)], "aa string, x double, y double, z double")

    def state(d):
        return [d[i] - sum((d[j] - d[i]) / (j - i) ** 2 for j in range(3) if j != i) for i in range(3)]

    es = {"A": state([1, 2, 4]), "C": state([0, 1, 5])}
    assert {r.aa: r.estate for r in S.estate_rows(table, "aa").collect()} == es
    seqs = spark.createDataFrame([(1, "AAU"), (2, "C"), (3, "AZ")], "k int, s string")
    m = {r.k: r for r in S.residue_means(seqs, ["k"], "s", S.estate_rows(table, "aa")).collect()}
    assert np.allclose(m[1]["mean"], (2 * np.array(es["A"]) + es["C"]) / 3) and m[1].length == 3 and not m[3].known
    row = spark.createDataFrame([(m[1]["mean"], 3, m[2]["mean"], 1)], "a array<double>, n int, b array<double>, k int").select(S.pair_descriptor(*map(F.col, "anbk")).alias("v")).first()
    joint = (2 * np.array(es["A"]) + 2 * np.array(es["C"])) / 4
    assert np.allclose(row.v, 2 * joint - 2 * np.array(m[1]["mean"]) - 2 * np.array(es["C"]))


def test_scalars(spark):
    row = spark.range(1).select(
        X.lenient_double(F.lit("0.948 [0.9, 1.0]")).alias("a"), X.lenient_double(F.lit("n/a")).alias("b"), X.ci_text(F.lit(0.12345), F.lit(0.9)).alias("c"), X.clamp01(F.lit(1.2)).alias("d"),
        X.path_part(F.lit("/x/y/z/"), 2).alias("e"), X.chi_square(*map(F.lit, (10, 0, 0, 10))).alias("f"), X.chi_square(*map(F.lit, (0, 0, 0, 0))).alias("g"), X.safe_ratio(F.lit(1), F.lit(0)).alias("h"),
    ).first()
    assert tuple(row) == (0.948, None, "[0.123, 0.900]", 1.0, "y", 20.0, 0.0, None)
    assert len(X.colour_scale()) == 9 and X.models_per_balance(200, 3) == 67


def test_loading_and_nulls(spark):
    ddi = spark.createDataFrame([(1, 2, True, True), (2, 1, False, None), (1, 1, None, False)], "domain_id_a long, domain_id_b long, negative boolean, is_evaluation_relevant boolean")
    domain = spark.createDataFrame([(1, "B"), (2, "A")], "id long, pfam_id string")
    assert sorted(map(tuple, pairs.load_ddi(ddi, domain).collect())) == [("A", "B", 0, 1), ("A", "B", 1, 0), ("B", "B", 0, 0)]
    assert sorted(map(str, (tuple(r) for r in pairs.extract_ddi(ddi, True).collect()))) == ["(1, 2, 0)"] and pairs.extract_ddi(ddi, False).filter("interaction IS NULL").count() == 1
    both = pairs.symmetrised(spark.createDataFrame([("a", "b", 1), ("c", "c", 0)], "x string, y string, l int"), "x", "y")
    assert sorted((r.x, r.y) for r in both.collect()) == [("a", "b"), ("b", "a"), ("c", "c")]


def brute_auc(y, s):
    p, n = [b for a, b in zip(y, s) if a], [b for a, b in zip(y, s) if not a]
    return sum((a > b) + 0.5 * (a == b) for a in p for b in n) / (len(p) * len(n))


def test_areas_thresholds_and_bootstrap(spark):
    draw = random.Random(2)
    rows = [(m, draw.randint(0, 1), draw.randint(0, 20) / 20) for m in ("a", "b") for _ in range(150)] + [("one", 1, 0.5), ("one", 1, None)]
    df = spark.createDataFrame(rows, "model string, y int, s double")
    counts = evaluation.curve_counts(df, ["model"], "y", "s")
    got = {r.model: r for r in evaluation.areas(counts, ["model"]).collect()}
    for m in "ab":
        y, s = zip(*[(b, c) for a, b, c in rows if a == m])
        assert got[m].roc_auc == pytest.approx(brute_auc(y, s)) == pytest.approx(evaluation.auc_of(np.array(y), np.array(s)))
        assert got[m].pr_ap == pytest.approx(evaluation.ap_of(np.array(y), np.array(s)))
    assert got["one"].roc_auc is None
    boot = {r.model: r for r in evaluation.bootstrap(df, ["model"], "y", "s", resamples=100).collect()}
    assert boot["a"].lo <= boot["a"].hi and len(boot["a"].samples) == 100 and boot["one"].point in (None,)
    cut = {r.model: r for r in evaluation.threshold_by_mcc(df, ["model"], "y", "s", 50).collect()}

    def mcc(y, p):
        tp, tn, fp, fn = (sum((a == c) and (b == d) for a, b in zip(y, p)) for c, d in ((1, 1), (0, 0), (0, 1), (1, 0)))
        den = (tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)
        return (tp * tn - fp * fn) / den**0.5 if den else 0.0

    y, s = zip(*[(b, c) for a, b, c in rows if a == "a"])
    grid = sorted(set(np.quantile(s, [k / 51 for k in range(1, 51)]).tolist()))
    best = max(grid, key=lambda t: (round(mcc(y, [x >= t for x in s]), 12), -t))
    assert cut["a"].threshold == pytest.approx(best)
    points = evaluation.roc_points(counts, ["model"])
    few = evaluation.decimated(points, ["model"], 7)
    n = points.filter("model = 'a'").count()
    assert sorted(r.place for r in few.filter("model = 'a'").collect()) == sorted({int(k * (n - 1) / 6) for k in range(7)})
    assert evaluation.roc_points(counts, ["model"], drop_collinear=True).count() <= points.count()
    assert {r.model: r.value for r in evaluation.metric_udaf(df.filter("model != 'one'"), ["model"], "y", "s", lambda a, b: len(a)).collect()} == {"a": 150, "b": 150}


def test_graph_distances_components_and_biclusters(spark):
    edges = spark.createDataFrame([("r", "a"), ("r", "b"), ("a", "c"), ("c", "d"), ("x", "y"), ("s", "s")], "parent string, child string")
    got = {(r.source, r.node): r.dist for r in graph.bounded_distances(edges, spark.createDataFrame([("d",), ("x",)], "t string"), 3).collect()}
    assert got == {("d", "d"): 0, ("d", "c"): 1, ("d", "a"): 2, ("d", "r"): 3, ("x", "x"): 0, ("x", "y"): 1}
    comps = {r.node: r.component for r in graph.connected_components(edges, spark.createDataFrame([("lone",)], "n string")).collect()}
    assert comps == {**dict.fromkeys("rabcd", "a"), "x": "x", "y": "x", "s": "s", "lone": "lone"}
    chain = spark.range(60).selectExpr("id AS a", "id + 1 AS b")
    assert {r.component for r in graph.connected_components(chain).collect()} == {0}
    block = spark.createDataFrame([("t", a, b) for a in "abc" for b in "xyz"], "go string, a string, b string")
    found = {(r.a, r.b) for r in graph.bicluster_pairs(graph.guarded(block), 0.4).collect()}
    assert {(a, b) for a in "abc" for b in "xyz"} <= found
    d = {r.node: r.degree for r in graph.degrees(edges).collect()}
    assert d["s"] == 2 and d["a"] == 2


def test_chi_square_equals_brute_force(spark):
    draw = random.Random(4)
    proteins = [f"p{k:02d}" for k in range(12)]
    pd = {p: set(draw.sample("ABCDE", draw.randint(1, 3))) for p in proteins}
    ppi = draw.sample(list(itertools.combinations(proteins, 2)), 30)
    group = {e: f"g{draw.randint(0, 3)}" for e in ppi}
    df = spark.createDataFrame([(g, *e) for e, g in group.items()], "group_name string, protein_a string, protein_b string")
    mapping = spark.createDataFrame([(p, d) for p, ds in pd.items() for d in ds], "uniprot_id string, pfam_id string")
    shown = {e: {tuple(sorted((x, y))) for x in pd[e[0]] for y in pd[e[1]]} for e in ppi}
    want = {}
    for g in set(group.values()):
        for pair in {q for e in ppi if group[e] == g for q in shown[e]}:
            a = sum(group[e] == g and pair in shown[e] for e in ppi)
            b = sum(group[e] != g and pair in shown[e] for e in ppi)
            c = sum(group[e] == g for e in ppi) - a
            d = len(ppi) - a - b - c
            den = (a + c) * (b + d) * (a + b) * (c + d)
            want[g, *pair] = len(ppi) * (a * d - c * b) ** 2 / den if den else 0.0
    got = {(r.group_name, r.d1, r.d2): r.chi2 for r in graph.group_chi_square(df, mapping).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
    scores = graph.group_chi_square(df, mapping)
    assert graph.select_by_quantile(scores, 0).count() == len(want)
    top = graph.select_by_quantile(scores, 1.0).groupBy("group_name").agg(F.min("chi2").alias("lo")).collect()
    assert all(r.lo == pytest.approx(max(v for k, v in want.items() if k[0] == r.group_name)) for r in top)


def test_balance_and_sampling(spark):
    df = spark.range(1000).selectExpr("id AS k", "CAST(id % 10 = 0 AS int) AS y")
    down = assembly.downsample(df, "y", ["k"], 1)
    assert {r.y: r["count"] for r in down.groupBy("y").count().collect()} == {0: 100, 1: 100}
    assert sorted(r.k for r in down.collect()) == sorted(r.k for r in assembly.downsample(df.repartition(7), "y", ["k"], 1).collect())
    over = {r.y: r["count"] for r in assembly.oversample(df, "y", ["k"], 1).groupBy("y").count().collect()}
    assert over == {0: 900, 1: 900}
    few = assembly.smallest_by_hash(df, ["y"], ["k"], 5, 3)
    assert {r.y: r["count"] for r in few.groupBy("y").count().collect()} == {0: 5, 1: 5}
    moved = graph.permuted(df.select("k", "y"), "k", "y", 5)
    assert moved.count() == 1000 and moved.agg(F.sum("y")).first()[0] == 100 and moved.select("k").distinct().count() == 1000


def test_catalog_and_reports(spark):
    assert catalog.option_list("a, none,b,,a", "b") == ["a"] and catalog.feature_combinations(["x", "y"]) == [["x"], ["y"], ["x", "y"]] and catalog.feature_combinations(["x"]) == [["x"]]
    row = spark.range(1).select(catalog.option_array(F.lit("a, none,b,c"), F.lit("b")).alias("v")).first()
    assert row.v == ["a", "c"]
    parts = catalog.routed(spark.range(10), small=F.col("id") < 3, even=F.col("id") % 2 == 0)
    assert {k: v.count() for k, v in parts.items()} == {"small": 3, "even": 3, "other": 4}
    registry = catalog.Registry()
    registry.add("f", "pair")(lambda: None)
    assert registry.names("pair") == ["f"] and registry.names("domain") == []
    with pytest.raises(KeyError):
        registry["g"]
    old = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "model string, v double")
    new = spark.createDataFrame([("b", 3.0), ("c", None)], "model string, v double")
    assert {r.model: r.v for r in report.merged(old, new, ["model"], ["v"]).collect()} == {"a": 1.0, "b": 3.0, "c": None}
    blocks = spark.createDataFrame([("ml_roc_db1",), ("ml_metrics_table_proc",), ("db_pr",)], "id string")
    assert {r.id for r in report.pass_through(blocks, ["roc", "pr"]).collect()} == {"ml_metrics_table_proc"}
    assert {r.db for r in report.old_names(blocks).collect()} == {"db1", "proc", "pr"}
    values = spark.createDataFrame([("m", "d1", "0.9 [x]"), ("m", "d2", "0.5"), ("n", "d1", "0.1")], "model string, db string, value string")
    assert {r.model: (r.d1, r.d2) for r in report.heatmap(values, ["d1", "d2"]).collect()} == {"m": (0.9, 0.5), "n": (0.1, None)}
    table = spark.createDataFrame([("m", 0.5, 0.25)], "model string, acc double, f1 double")
    assert {r.metric: r.models for r in report.overview(table, ["acc", "f1"]).collect()} == {"acc": {"m": 0.5}, "f1": {"m": 0.25}}
    one = report.block(report.overview(table, ["acc"]), "overview", "Metrics", "table", "Metrics", F.map_from_entries(F.collect_list(F.struct("metric", "models"))), "db1").first()
    assert one.id == "overview_db1" and '"acc":{"m":0.5}' in one.data
