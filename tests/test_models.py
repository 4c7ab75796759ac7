import pytest
from pyspark.sql import functions as F

from weftline.operators import graph_models as G
from weftline.operators import models as M
from weftline.operators.assembly import assemble
from weftline.operators.features import FEATURES
from weftline.streaming import predictions


@pytest.fixture(scope="module")
def rows(spark):
    base = spark.range(240).select(F.concat(F.lit("a"), (F.col("id") % 60).cast("string")).alias("domain_a"), F.lit("b").alias("domain_b"), (F.col("id") % 2).cast("int").alias("label"), "id")
    noise = lambda k: (F.xxhash64(F.lit(k), "id") % 100) / 400.0
    return base.withColumn("features", F.array(F.col("label") + noise(1), noise(2), noise(3)).cast("array<float>")).drop("id").cache()


@pytest.mark.parametrize("name", ["random_forest", "neural_network"])
def test_train_predict_and_reload(spark, rows, tmp_path, name):
    space = {"n_estimators": [5], "max_depth": [2, 4]} if name == "random_forest" else {"hidden": [[8], [4]], "epochs": [15], "rate": [0.02], "batch": [32], "dropout": [0.1]}
    model = M.MODELS[name]()
    fitted, params, threshold = M.train(model, lambda split, balance: rows, {"space": space, "balance_method": [None]}, str(tmp_path), 7)
    out = M.predict(model, fitted, rows, threshold)
    assert out.filter("true_interaction = predicted_interaction").count() == out.count() == 60
    again = M.predict_only(spark, name, str(tmp_path), rows)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, out.collect()))
    assert M.drawn_settings({"a": [1, 2, 3], "b": [4, 5]}, 3, 1) == M.drawn_settings({"a": [1, 2, 3], "b": [4, 5]}, 3, 1)


def test_features_and_assembly(spark):
    mapping = spark.createDataFrame([(k % 5, k, "ACDEFGHIKLMNPQRSTVWY"[k % 7 :], 0, 3) for k in range(15)], "domain_id long, protein_id long, domain_sequence string, start_pos int, end_pos int")
    tables = {"domain_protein_map": mapping, "domain_domain_interaction": spark.createDataFrame([(0, 1), (2, 3)], "domain_id_a long, domain_id_b long")}
    long = None
    for name in ("aacomp", "aaencode", "dummy"):
        f = FEATURES[name](tables).withColumn("feature", F.lit(name))
        long = f if long is None else long.unionByName(f)
    ddi = spark.createDataFrame([("0", "1", 1), ("2", "3", 0), ("3", "9", 1)], "domain_1 string, domain_2 string, interaction int")
    out = assemble(ddi, long, ["aacomp", "aaencode", "dummy"], most_per_pair=4)
    assert {r.n for r in out.select(F.size("features").alias("n")).distinct().collect()} == {2 * (20 + 343 + 512)}
    per = {(r.domain_a, r.domain_b): r["count"] for r in out.groupBy("domain_a", "domain_b").count().collect()}
    assert per == {("0", "1"): 4, ("1", "0"): 4, ("2", "3"): 4, ("3", "2"): 4}
    table = spark.createDataFrame([(a, float(k), float(k * k % 7)) for k, a in enumerate("ACDEFGHIKLMNPQRSTVWY")], "aa string, x double, y double")
    assert FEATURES["protdcal"](tables, table).count() == 18 and FEATURES.level("protdcal") == "pair"


@pytest.fixture(scope="module")
def split(spark):
    proteins = [f"p{k}" for k in range(12)]
    pd = spark.createDataFrame([(p, f"D{(k * j) % 5}") for k, p in enumerate(proteins) for j in (1, 2)], "uniprot_id string, pfam_id string").distinct()
    ppi = spark.createDataFrame([(proteins[a], proteins[b], 950 if (a + b) % 3 else 100) for a in range(12) for b in range(a + 1, 12) if (a * b) % 4 != 1], "protein_a string, protein_b string, score int")
    go = spark.createDataFrame([(p, f"GO:{2 + k % 3}") for k, p in enumerate(proteins)], "uniprot_id string, go string")
    ddi = spark.createDataFrame([(f"D{a}", f"D{b}", (a + b) % 2, 1) for a in range(5) for b in range(a, 5)], "domain_a string, domain_b string, interaction int, eval_relevant int")
    return G.Split(ddi.cache(), pd.cache(), ppi.cache(), go.cache())


def test_network_model(spark, split):
    ontology = spark.createDataFrame([("GO:1", "GO:2", 1, 1), ("GO:1", "GO:3", 1, 1), ("GO:3", "GO:4", 2, 2)], "parent string, child string, depth int, level int")
    config = G.NetworkConfig(chi_square_cutoffs=[0.0, 0.5], bicluster_cutoffs=[0.5], threshold=1)
    out, chosen = G.network_model(split, split, ontology, config)
    got = out.collect()
    assert chosen[0] in (0.0, 0.5) and len(got) == 15 and all(0 <= r.predicted_probability <= 1 for r in got)
    fixed, used = G.network_model(None, split, ontology, G.NetworkConfig(threshold=1, optimized=chosen))
    assert used == chosen and sorted(map(tuple, fixed.collect())) == sorted(map(tuple, got))


def test_parsimony_model(split, monkeypatch):
    monkeypatch.setattr(G.nullmodels, "ROUNDS", 4)
    config = G.ParsimonyConfig(reliabilities=[0.5, 1.0], iterations=6, runs=3)
    out, chosen = G.parsimony_model(split, split, config)
    assert chosen[0] in (0.5, 1.0) and out.count() == 15
    again, _ = G.parsimony_model(None, split, G.ParsimonyConfig(iterations=6, runs=3, optimized=chosen))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, out.collect()))


def test_streamed_metrics(spark, tmp_path):
    schema = "domain_a string, domain_b string, true_interaction byte, predicted_interaction byte, predicted_probability float"
    make = lambda name, k: spark.createDataFrame([("a", str(i), i % 2, (i + k) % 2, i / 9) for i in range(9)], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in" / "db1" / name))
    table = str(tmp_path / "table")
    make("m1", 0)
    predictions.upsert_metrics(predictions.watch(spark, str(tmp_path / "in")), table, str(tmp_path / "cp")).awaitTermination()
    first = {r.model: r.accuracy for r in predictions.latest(spark, table).collect()}
    make("m2", 1)
    predictions.upsert_metrics(predictions.watch(spark, str(tmp_path / "in")), table, str(tmp_path / "cp")).awaitTermination()
    assert first == {"m1": 1.0} and {r.model: r.accuracy for r in predictions.latest(spark, table).collect()} == {"m1": 1.0, "m2": 0.0}
