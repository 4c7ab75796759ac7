"""The full benchmark: sample sheet to predictions, metrics and report blocks, as lazily composed plans.

Results are written where a later step reads them again (features,
predictions), everything else is one plan. All databases, splits, features and
models share it as columns.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import evaluation, graph, graph_models, models, pairs, report
from ..operators.assembly import assemble
from ..operators.catalog import feature_combinations
from ..operators.features import FEATURES
from ..sources import files, sinks, sqlite_source

TABLES = {
    "domain": "id bigint, pfam_id string",
    "protein": None,
    "domain_protein_map": None,
    "domain_domain_interaction": None,
    "protein_protein_interaction": "protein_id_a bigint, protein_id_b bigint, score bigint",
    "protein_go_terms": "protein_id bigint, go_accession string",
}
ML_MODELS = tuple(models.MODELS)
EVALUATED = ["samples", "accuracy", "recall", "specificity", "precision", "balanced_accuracy", "f1", "mcc"]


@dataclass
class Options:
    """What to run. graph_configs: name of a graph model -> its configuration."""

    features: list[str] = field(default_factory=lambda: ["aacomp"])
    ml_models: list[str] = field(default_factory=lambda: ["random_forest"])
    ml_config: dict[str, dict] = field(default_factory=dict)
    graph_configs: dict[str, object] = field(default_factory=dict)
    ontology: str | None = None
    properties: str | None = None
    most_per_pair: int | None = None
    bootstrap: int = 1000
    seed: int = 42


def load_split(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    return {t: sqlite_source.read_table(spark, path, t, schema) for t, schema in TABLES.items()}


def graph_split(tables: dict[str, DataFrame]) -> graph_models.Split:
    return graph_models.Split(
        pairs.load_ddi(tables["domain_domain_interaction"], tables["domain"]),
        pairs.load_protein_domains(tables["domain_protein_map"], tables["domain"], tables["protein"]),
        pairs.load_ppi(tables["protein_protein_interaction"], tables["protein"]),
        pairs.load_go(tables["protein_go_terms"], tables["protein"]),
    )


def extract_features(spark: SparkSession, splits: dict[str, dict[str, DataFrame]], db: str, names: list[str], properties: str | None, path: str) -> None:
    """Write every feature of every split of a database; pair features under path-pairs."""
    for level, target in (("domain", path), ("pair", f"{path}-pairs")):
        parts = []
        for split, tables in splits.items():
            for name in names:
                if FEATURES.level(name) == level:
                    found = FEATURES[name](tables, files.read_properties(spark, properties)) if level == "pair" else FEATURES[name](tables)
                    parts.append(found.withColumns({"db": F.lit(db), "split": F.lit(split), "feature": F.lit(name), "vec": F.col("vec").cast("array<float>")}))
        if parts:
            rows = reduce(lambda a, b: a.unionByName(b), parts)
            if level == "domain":
                sinks.write_features(rows, target)
            else:
                rows.write.mode("overwrite").partitionBy("db", "split", "feature").parquet(target)


def run_database(spark: SparkSession, db: str, db_path: str, out: str, options: Options) -> None:
    """Features, models and predictions of one database, below out/<db>/."""
    single = len(sqlite_source.split_files(db_path)) == 1
    splits = {s: load_split(spark, p) for s, p in sqlite_source.split_files(db_path).items()}
    extracts = {s: pairs.extract_ddi(t["domain_domain_interaction"], relevant_only=not single).select(*(F.col(c).cast("string").alias(c) for c in ("domain_1", "domain_2")), "interaction") for s, t in splits.items()}
    sinks.write_extract(reduce(lambda a, b: a.unionByName(b), (e.withColumns({"db": F.lit(db), "split": F.lit(s)}) for s, e in extracts.items())), f"{out}/{db}/ddi")
    if options.ml_models:
        if missing := {"train", "optimization", "test"} - set(splits):
            raise ValueError(f"{db} lacks the splits {', '.join(sorted(missing))}, which training needs")
        home = f"{out}/{db}/features"
        extract_features(spark, splits, db, options.features, options.properties, home)
        stored = spark.read.parquet(home).withColumns({k: F.col(k).cast("string") for k in ("domain_id", "protein_id")})
        for combo in feature_combinations(options.features):
            own = [f for f in combo if FEATURES.level(f) == "domain"]
            extra = [f for f in combo if FEATURES.level(f) == "pair"]
            if not own:
                continue

            def load(split: str, balance: str | None, own=own, extra=extra) -> DataFrame:
                pair_rows = None
                if extra:
                    keys = ("domain_a", "domain_b", "protein_a", "protein_b")
                    pair_rows = spark.read.parquet(f"{home}-pairs").filter((F.col("split") == split) & (F.col("feature") == extra[0])).select(*(F.col(k).cast("string").alias(k) for k in keys), "vec")
                return assemble(extracts[split].filter("interaction IS NOT NULL"), stored.filter(F.col("split") == split), own, pair_rows, options.most_per_pair, balance, seed=options.seed)

            for name in options.ml_models:
                model, label = models.MODELS[name](), f"{name}_{'+'.join(combo)}"
                fitted, _, threshold = models.train(model, load, options.ml_config.get(name, {}), f"{out}/{db}/models/{label}", options.seed)
                sinks.write_predictions(models.predict(model, fitted, load("test", None), threshold), f"{out}/predictions/{db}/{label}")
    for name, config in options.graph_configs.items():
        train = graph_split(splits["train"]) if "train" in splits else None
        args = (files.read_ontology(spark, options.ontology),) if name == "network" else ()
        predictions, chosen = graph_models.GRAPH_MODELS[name](train, graph_split(splits["test"]), *args, config)
        sinks.write_predictions(predictions, f"{out}/predictions/{db}/{name}")
        sinks.save_params(spark, f"{out}/{db}/models/{name}/params", name, {"optimized": chosen}, None, None)
    network = []
    for split, tables in splits.items():
        ppi = pairs.load_ppi(tables["protein_protein_interaction"], tables["protein"]).select("protein_a", "protein_b")
        ddi = pairs.load_ddi(tables["domain_domain_interaction"], tables["domain"])
        for kind, edges, label in (("ppi", ppi, None), ("ddi", ddi.select("domain_a", "domain_b", "interaction"), "interaction")):
            rows = edges.withColumns({"split": F.lit(split), "kind": F.lit(kind)})
            a, b = edges.columns[:2]
            network.append(report.db_analysis(graph.network_counts(rows.select("split", "kind", a, b), ["split", "kind"]), graph.interaction_counts(rows, ["split", "kind"], label)))
    reduce(lambda a, b: a.unionByName(b), network).withColumn("db", F.lit(db)).write.mode("overwrite").parquet(f"{out}/networks/{db}")


def evaluate_all(spark: SparkSession, out: str, options: Options) -> dict[str, DataFrame]:
    """metrics, intervals and curves of every model of every database, in one plan over all predictions."""
    rows = files.read_prediction_tree(spark, f"{out}/predictions/*/*/*.parquet")
    by, label, score = ["db", "model"], "true_interaction", "predicted_probability"
    counts = evaluation.curve_counts(rows, by, label, score)
    intervals = None
    for metric, short in (("roc_auc", "roc"), ("pr_ap", "pr")):
        one = evaluation.bootstrap(rows, by, label, score, metric, options.bootstrap, options.seed).select(*by, F.col("lo").alias(f"{short}_lo"), F.col("hi").alias(f"{short}_hi"), F.col("samples").alias(f"{short}_samples"))
        intervals = one if intervals is None else intervals.join(one, by)
    return {
        "metrics": evaluation.evaluate(rows, by),
        "intervals": intervals,
        "roc": evaluation.decimated(evaluation.roc_points(counts, by), by),
        "pr": evaluation.decimated(evaluation.pr_points(counts, by), by),
    }


def report_blocks(found: dict[str, DataFrame], networks: DataFrame, db: str) -> DataFrame:
    """The report blocks of one database."""
    own = {k: v.filter(F.col("db") == db) for k, v in found.items()}
    by_key = lambda key: lambda a, b: F.when(a[key] < b[key], -1).when(a[key] > b[key], 1).otherwise(0)
    pack = lambda key, value: F.map_from_entries(F.array_sort(F.collect_list(F.struct(key, value)), by_key(key)))
    table = report.auc_table(own["metrics"].select("model", "roc_auc", "pr_ap"), own["intervals"]).select("model", F.struct("roc_auc", "roc_auc_ci", "pr_ap", "pr_ap_ci").alias("v"))
    roc = report.curves_by(own["roc"], ["model"], "fpr", "tpr", [F.col("place")])
    pr = report.curves_by(own["pr"], ["model"], "recall", "precision", [F.col("place")])
    grid = report.significance_grid(evaluation.pairwise_significance(own["intervals"].select("model", F.col("roc_samples").alias("samples"))))
    nets = networks.filter(F.col("db") == db).select("name", F.struct("num_nodes", "num_edges", "total_interactions", "num_positive_interactions", "num_negative_interactions").alias("v"))
    blocks = [
        report.block(table, "metrics_table", "Model performance", "table", "Model performance (AUC / AP)", pack("model", "v"), db),
        report.block(roc, "roc", "ROC", "linegraph", "ROC curves", pack("model", "points"), db),
        report.block(pr, "pr", "Precision-recall", "linegraph", "Precision-recall curves", pack("model", "points"), db),
        report.block(report.overview(own["metrics"], EVALUATED), "metrics_overview", "Metrics", "table", "Metrics", pack("metric", "models"), db),
        report.block(grid, "pairwise_significance", "Significance", "table", "Pairwise significance (two-sided p)", pack("model_a", "p"), db),
        report.block(nets, "database_analysis", "Networks", "table", "Interaction networks", pack("name", "v"), db),
    ]
    return reduce(lambda a, b: a.unionByName(b), blocks)


def run(spark: SparkSession, samplesheet: str, out: str, options: Options, root: str = "") -> DataFrame:
    """Everything, for each database of a sample sheet; returns the metrics of all models."""
    sheet = files.read_samplesheet(spark, samplesheet, root)
    if fault := files.samplesheet_faults(sheet).head(1):
        raise ValueError(f"sample sheet: {fault[0].fault} ({fault[0].id})")
    names = [tuple(r) for r in sheet.select("id", "db_path").collect()]  # a row for each database
    for db, path in names:
        run_database(spark, db, path, out, options)
    found = evaluate_all(spark, out, options)
    sinks.write_json_rows(found["metrics"], f"{out}/metrics")
    networks = spark.read.parquet(*(f"{out}/networks/{db}" for db, _ in names))
    for db, _ in names:
        sinks.write_blocks(report_blocks(found, networks, db), f"{out}/report/{db}")
    across = found["metrics"].select("model", "db", F.col("roc_auc").alias("value"))
    report.heatmap(across, [db for db, _ in names]).write.mode("overwrite").parquet(f"{out}/report/roc_auc_by_db")
    return found["metrics"]
