"""Predictors: the plug-in contract, random forest, multi-layer perceptron, search, threshold, prediction."""

from __future__ import annotations

import itertools
from abc import ABC, abstractmethod
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.sinks import save_params
from .assembly import with_fold
from .evaluation import aggregate_pairs, threshold_by_mcc
from .lineage import Tables
from .perceptron import BLOCK_NUMBERS, Blocks, Perceptron
from .perceptron import train as train_perceptron

PAIR = ["domain_a", "domain_b"]


class PairModel(ABC):
    """A predictor over assembled rows (label, features): fit, score, save and load.

    balance_methods and search_keys say what a configuration holds; before_fit
    and score may be replaced.
    """

    name: str

    @abstractmethod
    def balance_methods(self, config: dict) -> list[str | None]: ...

    @abstractmethod
    def grid(self, config: dict) -> list[dict]:
        """All parameter settings of a configuration."""

    @abstractmethod
    def fit(self, rows: DataFrame, params: dict, seed: int): ...

    @abstractmethod
    def scored(self, fitted, rows: DataFrame) -> DataFrame:
        """rows with score, the probability of label 1."""

    @abstractmethod
    def save(self, fitted, path: str) -> None: ...

    @abstractmethod
    def load(self, spark: SparkSession, path: str): ...

    def before_fit(self, spark: SparkSession) -> None:
        """Called once before training."""

    def search(self, rows: DataFrame, grid: list[dict], seed: int) -> list[tuple[float, dict]]:
        """(average precision on fold 0, params) of each setting fitted on fold -1, best first; earlier settings win ties."""
        found = []
        train, held = rows.filter("fold = -1"), rows.filter("fold = 0")
        for k, params in enumerate(grid):
            ap = average_precision(self.scored(self.fit(train, params, seed), held))
            found.append((ap, -k, params))
        return [(ap, p) for ap, _, p in sorted(found, key=lambda x: x[:2], reverse=True)]


def average_precision(scored: DataFrame) -> float:
    from .evaluation import areas, curve_counts

    row = areas(curve_counts(scored.withColumn("_g", F.lit(1)), ["_g"], "label", "score"), ["_g"]).first()
    return float(row.pr_ap) if row is not None and row.pr_ap is not None else float("nan")


def all_settings(space: dict[str, list]) -> list[dict]:
    names = sorted(space)
    return [dict(zip(names, v)) for v in itertools.product(*(space[n] for n in names))]


def drawn_settings(space: dict[str, list], n: int, seed: int) -> list[dict]:
    """n settings of a grid without repetition, by seed."""
    every = all_settings(space)
    order = np.random.default_rng(seed).permutation(len(every))
    return [every[k] for k in sorted(order[:n].tolist())]


class RandomForest(PairModel):
    name = "random_forest"

    def balance_methods(self, config: dict) -> list[str | None]:
        return config.get("balance_method", [None])

    def grid(self, config: dict) -> list[dict]:
        return all_settings(config.get("space", {"n_estimators": [50], "max_depth": [10]}))

    def fit(self, rows: DataFrame, params: dict, seed: int) -> RandomForestClassificationModel:
        forest = RandomForestClassifier(
            labelCol="label", featuresCol="_x", probabilityCol="_p", seed=seed, numTrees=int(params.get("n_estimators", 50)), maxDepth=min(30, int(params.get("max_depth") or 30)),
            minInstancesPerNode=int(params.get("min_samples_leaf", 1)), featureSubsetStrategy=str(params.get("max_features", "sqrt")), maxBins=int(params.get("n_bins", 32)),
        )
        return forest.fit(rows.select(F.col("label").cast("double").alias("label"), array_to_vector(F.transform("features", lambda v: v.cast("double"))).alias("_x")))

    def scored(self, fitted: RandomForestClassificationModel, rows: DataFrame) -> DataFrame:
        out = fitted.transform(rows.withColumn("_x", array_to_vector(F.transform("features", lambda v: v.cast("double")))))
        return out.withColumn("score", vector_to_array("_p")[1]).select(*rows.columns, "score")

    def save(self, fitted: RandomForestClassificationModel, path: str) -> None:
        fitted.write().overwrite().save(path)

    def load(self, spark: SparkSession, path: str) -> RandomForestClassificationModel:
        return RandomForestClassificationModel.load(path)


#: Fits of a search that run at the same time.
SIDE_BY_SIDE = 8


class NeuralNetwork(PairModel):
    """A perceptron, trained on all rows in blocks (see perceptron); SIDE_BY_SIDE settings of a grid are fitted at a time."""

    name = "neural_network"

    def __init__(self, block_numbers: int = BLOCK_NUMBERS) -> None:
        self.block_numbers = block_numbers

    def balance_methods(self, config: dict) -> list[str | None]:
        return config.get("balance_method", [None])

    def grid(self, config: dict) -> list[dict]:
        return all_settings(config.get("space", {"hidden": [[32]], "rate": [1e-3], "dropout": [0.1], "batch": [64], "epochs": [20]}))

    @staticmethod
    def _trained(blocks: Blocks, p: dict, seed: int) -> Perceptron:
        return train_perceptron(blocks, list(p.get("hidden", [32])), float(p.get("rate", 1e-3)), int(p.get("epochs", 20)), float(p.get("dropout", 0.0)), int(p.get("batch", 64)), seed)

    def fit(self, rows: DataFrame, params: dict, seed: int) -> Perceptron:
        blocks = Blocks(rows.select("label", "features"), self.block_numbers)
        fitted = self._trained(blocks, params, seed)
        blocks.drop()
        return fitted

    def search(self, rows: DataFrame, grid: list[dict], seed: int) -> list[tuple[float, dict]]:
        """As in PairModel, with a few fits at a time: both folds are written once, and used whole."""
        tables = Tables(rows.sparkSession)
        blocks = Blocks(rows.filter("fold = -1").select("label", "features"), self.block_numbers)
        held = tables.written(rows.filter("fold = 0").select("label", "features"), "held")

        def one(params: dict) -> float:
            return average_precision(self.scored(self._trained(blocks, params, seed), held))

        with ThreadPoolExecutor(SIDE_BY_SIDE) as pool:
            found = list(pool.map(inheritable_thread_target(rows.sparkSession)(one), grid))
        blocks.drop()
        tables.drop("held")
        order = sorted(range(len(grid)), key=lambda k: (-found[k] if found[k] == found[k] else np.inf, k))
        return [(found[k], grid[k]) for k in order]

    def scored(self, fitted: Perceptron, rows: DataFrame) -> DataFrame:
        text = fitted.to_json()

        @F.pandas_udf("double")
        def score(x: pd.Series) -> pd.Series:
            return pd.Series(Perceptron.from_json(text).forward(np.array(x.tolist(), np.float64))) if len(x) else pd.Series([], dtype=float)

        return rows.withColumn("score", score("features"))

    def save(self, fitted: Perceptron, path: str) -> None:
        SparkSession.active().createDataFrame([(fitted.to_json(),)], "value string").coalesce(1).write.mode("overwrite").text(path)

    def load(self, spark: SparkSession, path: str) -> Perceptron:
        return Perceptron.from_json(spark.read.text(path).first().value)


MODELS: dict[str, Callable[[], PairModel]] = {"random_forest": RandomForest, "neural_network": NeuralNetwork}


def train(model: PairModel, load: Callable[[str, str | None], DataFrame], config: dict, path: str, seed: int = 42) -> tuple[object, dict, float]:
    """Search over balance methods and settings, refit on train alone, tune the threshold on optimization.

    load(split, balance) gives assembled rows. Writes the model and its
    parameters below path, and returns the fitted model, parameters, threshold.
    """
    held = load("optimization", None)
    spark = held.sparkSession
    model.before_fit(spark)
    methods = model.balance_methods(config)
    best = None
    grid = model.grid(config)
    n = config.get("n_models")
    if n:
        grid = [grid[k] for k in sorted(np.random.default_rng(seed).permutation(len(grid))[: -(-n // len(methods))].tolist())]
    for method in methods:
        ap, params = model.search(with_fold(load("train", method), held), grid, seed)[0]
        if best is None or ap > best[0]:
            best = (ap, params, method)
    _, params, method = best
    fitted = model.fit(load("train", method), params, seed)
    pairs = aggregate_pairs(model.scored(fitted, held), PAIR, "label", "score")
    cut = threshold_by_mcc(pairs.withColumn("_g", F.lit(1)), ["_g"], "label", "score").first()
    threshold = float(cut.threshold) if cut is not None else 0.5
    model.save(fitted, f"{path}/model")
    save_params(spark, f"{path}/params", model.name, params, method, threshold)
    return fitted, params, threshold


def predict(model: PairModel, fitted, rows: DataFrame, threshold: float) -> DataFrame:
    """Predictions by pair: mean probability over a pair's proteins, and whether it reaches the threshold."""
    pairs = aggregate_pairs(model.scored(fitted, rows), PAIR, "label", "score")
    return pairs.select(
        *PAIR, F.col("label").cast("byte").alias("true_interaction"), (F.col("score") >= threshold).cast("byte").alias("predicted_interaction"), F.col("score").cast("float").alias("predicted_probability")
    )


def predict_only(spark: SparkSession, name: str, path: str, rows: DataFrame) -> DataFrame:
    """Predictions of a saved model."""
    model = MODELS[name]()
    params = spark.read.json(f"{path}/params").first()
    return predict(model, model.load(spark, f"{path}/model"), rows, float(params.threshold))
