"""Predictor evaluation: confusion metrics, curves, areas, bootstrap, significance, thresholds.

Everything is grouped by model columns, so all predictors are evaluated in one
plan. Curves rank distinct scores, not rows: rows are summed by score first.
Running counts, places and quantiles come from ranges of scores and their bases (see ranges),
so a single model with all rows spreads over all tasks.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import safe_ratio
from .ranges import Ranges, quantiles, running_totals, same


def usable(df: DataFrame, label: str, score: str) -> DataFrame:
    """Rows with a label and a score that is a number."""
    return df.filter(F.col(label).isNotNull() & F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")))


def aggregate_pairs(df: DataFrame, keys: list[str], label: str, score: str) -> DataFrame:
    """One row for each pair: mean score, and the label (the largest, if they differ)."""
    return df.groupBy(*keys).agg(F.max(label).alias(label), F.avg(F.col(score).cast("double")).alias(score), F.count(F.lit(1)).alias("rows"))


def confusion(df: DataFrame, by: list[str], label: str, predicted: str) -> DataFrame:
    y, p = F.col(label) == 1, F.col(predicted) == 1
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("samples"), F.count_if(y & p).alias("tp"), F.count_if(~y & ~p).alias("tn"), F.count_if(~y & p).alias("fp"), F.count_if(y & ~p).alias("fn")
    )


def mcc(tp: Column, tn: Column, fp: Column, fn: Column) -> Column:
    """Matthews correlation, 0 where a class is empty; in doubles."""
    tp, tn, fp, fn = (x.cast("double") for x in (tp, tn, fp, fn))
    den = (tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)
    return F.when(den == 0, F.lit(0.0)).otherwise((tp * tn - fp * fn) / F.sqrt(den))


def metrics(counts: DataFrame) -> DataFrame:
    """confusion()'s rows with the derived metrics; undefined ones are null."""
    tp, tn, fp, fn = (F.col(c) for c in ("tp", "tn", "fp", "fn"))
    out = counts.withColumns(
        {"accuracy": safe_ratio(tp + tn, F.col("samples")), "recall": safe_ratio(tp, tp + fn), "specificity": safe_ratio(tn, tn + fp), "precision": safe_ratio(tp, tp + fp)}
    )
    return out.withColumns(
        {"balanced_accuracy": (F.col("recall") + F.col("specificity")) / 2, "f1": safe_ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), "mcc": mcc(tp, tn, fp, fn)}
    )


def crosstab_margins(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Counts by actual and predicted, with null for the margins."""
    return df.cube(actual, predicted).agg(F.count(F.lit(1)).alias("n"), F.grouping(actual).alias("all_actual"), F.grouping(predicted).alias("all_predicted"))


def summary(df: DataFrame, by: list[str], value: str) -> DataFrame:
    v = F.col(value)
    plain = df.groupBy(*by).agg(F.min(v).alias("min"), F.max(v).alias("max"), F.avg(v).alias("mean"), F.stddev_pop(v).alias("std"))
    middle = quantiles(df, by, value, [0.5]).drop("k").withColumnRenamed("quantile", "median").withColumnsRenamed({b: f"_m_{b}" for b in by})
    on = F.lit(True)
    for b in by:
        on = on & F.col(b).eqNullSafe(F.col(f"_m_{b}"))
    return plain.join(middle, on, "left").select(*by, "min", "max", "mean", "median", "std")


def score_steps(df: DataFrame, by: list[str], label: str, score: str) -> DataFrame:
    """by, score, and the positives p and negatives n of each distinct score."""
    return usable(df, label, score).groupBy(*by, F.col(score).cast("double").alias("score")).agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) != 1).alias("n"))


def curve_counts(df: DataFrame, by: list[str], label: str, score: str) -> DataFrame:
    """by, score, tp and fp: positives and negatives at this score or above; all_p, all_n; p and n at this score, and at the next lower one."""
    run = running_totals(score_steps(df, by, label, score), by, ["-score"], ["p", "n"], ahead=["p", "n"])
    return run.withColumnsRenamed({"run_p": "tp", "run_n": "fp"})


def roc_points(counts: DataFrame, by: list[str], drop_collinear: bool = False) -> DataFrame:
    """fpr and tpr by descending score, from (0, 0); null where a class is empty.

    drop_collinear: without points on a straight line between their neighbours,
    told by the counts of the steps before and after.
    """
    start = counts.groupBy(*by).agg(F.max("all_n").alias("n"), F.max("all_p").alias("p")).select(*by, F.lit(float("inf")).alias("score"), safe_ratio(F.lit(0), F.col("n")).alias("fpr"), safe_ratio(F.lit(0), F.col("p")).alias("tpr"))
    if drop_collinear:
        counts = counts.filter("next_p IS NULL OR all_p = 0 OR all_n = 0 OR CAST(n AS DECIMAL(19,0)) * next_p != CAST(p AS DECIMAL(19,0)) * next_n")
    pts = counts.select(*by, "score", safe_ratio(F.col("fp"), F.col("all_n")).alias("fpr"), safe_ratio(F.col("tp"), F.col("all_p")).alias("tpr"))
    return start.unionByName(pts)


def pr_points(counts: DataFrame, by: list[str]) -> DataFrame:
    """recall and precision by descending score, after the end point (0, 1)."""
    pts = counts.select(*by, "score", safe_ratio(F.col("tp"), F.col("all_p")).alias("recall"), (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"))
    end = counts.select(*by).distinct().select(*by, F.lit(float("inf")).alias("score"), F.lit(0.0).alias("recall"), F.lit(1.0).alias("precision"))
    return end.unionByName(pts)


def areas(counts: DataFrame, by: list[str]) -> DataFrame:
    """roc_auc (trapezoids) and pr_ap (sum of recall steps times precision) of curve_counts(); each step knows its own counts."""
    auc = F.sum(F.col("n") * (2 * F.col("tp") - F.col("p")).cast("double") / 2)
    ap = F.sum(F.col("p").cast("double") * F.col("tp") / (F.col("tp") + F.col("fp")))
    p, n = F.max("all_p"), F.max("all_n")
    return counts.groupBy(*by).agg(safe_ratio(auc, p.cast("double") * n).alias("roc_auc"), safe_ratio(ap, p).alias("pr_ap"), p.alias("positives"), n.alias("negatives"))


def decimated(points: DataFrame, by: list[str], most: int = 600) -> DataFrame:
    """At most `most` points of each curve: places floor(k (n - 1) / (most - 1)), in order of descending score.

    A point stays if the places hold its number, which needs no join.
    """
    run = running_totals(points.withColumn("_i", F.lit(1).cast("long")), by, ["-score"], ["_i"])
    rows = run.select(*points.columns, (F.col("run__i") - 1).alias("_i"), F.col("all__i").alias("_n"))
    # The k that might reach place i; floor is taken in integers.
    k = F.ceil(F.col("_i") * (most - 1) / F.greatest(F.col("_n") - 1, F.lit(1))).cast("long")
    hit = F.floor(k * (F.col("_n") - 1) / (most - 1)) == F.col("_i")
    return rows.filter((F.col("_n") <= most) | (hit & (k < most))).withColumnRenamed("_i", "place").drop("_n")


#: Distinct scores whose resamples are drawn at once.
DRAWN = 256


def _draws(rows: pd.DataFrame, resamples: int):
    """Slices of rows in falling order of score, with how often each resample draws their positives and negatives.

    Each score has a generator of its own, keyed by _h, so draws don't depend on how rows are dealt out.
    """
    rows = rows.sort_values("score", ascending=False, kind="stable")
    for lo in range(0, len(rows), DRAWN):
        some = rows.iloc[lo : lo + DRAWN]
        p, n = np.zeros((2, len(some), resamples))
        for k, (h, a, b) in enumerate(zip(some["_h"].tolist(), some["p"].tolist(), some["n"].tolist())):
            draw = np.random.Generator(np.random.Philox(key=h & (1 << 64) - 1))
            if a:
                p[k] = draw.poisson(a, resamples)
            if b:
                n[k] = draw.poisson(b, resamples)
        yield p, n


def bootstrap(df: DataFrame, by: list[str], label: str, score: str, metric: str = "roc_auc", resamples: int = 1000, seed: int = 42) -> DataFrame:
    """point, lo and hi (2.5 and 97.5 % quantiles), and samples of a metric for each group.

    A resample draws each row a Poisson(1) number of times, so each (score, label) comes
    Poisson(count) times, drawn by a key of its own: a resample's size varies by
    the root of the rows, which moves a ratio such as these metrics by less than
    its interval's width over that root. Scores lie in ranges. Each range adds up its draws for
    all resamples, prefix sums over ranges give bases, and each range then adds
    up its part of the metric; no row holds a group's scores. Resamples without
    both classes are NaN and are left out of the quantiles.
    """
    steps = score_steps(df, by, label, score).withColumn("_h", F.xxhash64(F.lit(seed), *by, "score"))
    laid = Ranges(steps, by, ["-score"])
    point = areas(laid.running(["p", "n"]).withColumnsRenamed({"run_p": "tp", "run_n": "fp"}), by).select(*by, F.col(metric).alias("point"))
    keys = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in steps.select(*by).schema)
    keys = f"{keys}, " if keys else ""
    unit = [*by, "_part"]

    def totals(rows: pd.DataFrame) -> pd.DataFrame:
        p, n = np.zeros((2, resamples))
        for dp, dn in _draws(rows, resamples):
            p, n = p + dp.sum(0), n + dn.sum(0)
        return rows[unit].iloc[:1].assign(_p=[p.tolist()], _n=[n.tolist()])

    drawn = laid.rows.groupBy(*unit).applyInPandas(totals, f"{keys}_part int, _p array<double>, _n array<double>")
    each = laid.tables.written(drawn, "drawn").select(*unit, F.posexplode(F.arrays_zip("_p", "_n")).alias("k", "d")).select(*unit, "k", "d._p", "d._n")
    before = Window.partitionBy(*by, "k").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    every = Window.partitionBy(*by, "k")
    based = each.select(*unit, "k", *(F.coalesce(F.sum(c).over(before), F.lit(0.0)).alias(f"b{c}") for c in ("_p", "_n")), *(F.sum(c).over(every).alias(f"a{c}") for c in ("_p", "_n")))
    listed = F.array_sort(F.collect_list(F.struct("k", "b_p", "b_n", "a_p", "a_n")))  # resamples of them
    bases = laid.tables.written(based.groupBy(*unit).agg(listed.alias("b")), "bases")
    # the bases are one row of each range, beside its scores
    head = bases.select(*unit, F.lit(None).cast("double").alias("score"), *(F.lit(0).cast("long").alias(c) for c in ("p", "n", "_h")), F.transform("b", lambda x: x["b_p"]).alias("tp"), F.transform("b", lambda x: x["b_n"]).alias("fp"))
    none = F.lit(None).cast("array<double>")
    rows = laid.rows.select(*unit, "score", "p", "n", "_h", none.alias("tp"), none.alias("fp")).unionByName(head)

    def measured(rows: pd.DataFrame) -> pd.DataFrame:
        top = rows[rows.score.isna()].iloc[0]
        tp, fp, total = np.array(top.tp, float), np.array(top.fp, float), np.zeros(resamples)
        for dp, dn in _draws(rows[rows.score.notna()], resamples):
            above, under = tp + np.cumsum(dp, axis=0), fp + np.cumsum(dn, axis=0)
            total += (dn * (above - dp / 2)).sum(0) if metric == "roc_auc" else (dp * above / np.maximum(above + under, 1)).sum(0)
            tp, fp = above[-1], under[-1]
        return rows[unit].iloc[:1].assign(v=[total.tolist()])

    sums = rows.groupBy(*unit).applyInPandas(measured, f"{keys}_part int, v array<double>")
    parts = sums.select(*by, F.posexplode("v").alias("k", "v")).groupBy(*by, "k").agg(F.sum("v").alias("v"))
    size = based.groupBy(*by, "k").agg(F.max("a_p").alias("ps"), F.max("a_n").alias("ns")).withColumnsRenamed({c: f"_s_{c}" for c in (*by, "k")})
    on = F.col("k") == F.col("_s_k")
    for b in by:
        on = on & F.col(b).eqNullSafe(F.col(f"_s_{b}"))
    value = F.when((F.col("ps") > 0) & (F.col("ns") > 0), F.col("v") / (F.col("ps") * F.col("ns") if metric == "roc_auc" else F.col("ps"))).otherwise(F.lit(float("nan")))
    whole = parts.join(size, on).groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct("k", value.alias("v")))), lambda x: x["v"]).alias("samples"))
    samples = whole.withColumn("_good", F.array_sort(F.filter("samples", lambda x: x.isNotNull() & ~F.isnan(x))))

    def quantile(q: float) -> Column:
        at = (F.size("_good") - 1) * F.lit(q)
        lo = F.floor(at).cast("int")
        a, b = F.try_element_at("_good", lo + 1), F.try_element_at("_good", F.ceil(at).cast("int") + 1)
        return F.when(F.size("_good") > 0, a + (b - a) * (at - lo))

    return samples.alias("s").join(point.alias("o"), same(samples, point, by)).select(*(F.col(f"s.{b}").alias(b) for b in by), "point", quantile(0.025).alias("lo"), quantile(0.975).alias("hi"), "samples")


def auc_of(y: np.ndarray, s: np.ndarray) -> float:
    """Area under the ROC curve by mean ranks."""
    order = np.argsort(s, kind="stable")
    ranked = s[order]
    first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    size = np.diff(np.append(first, len(s)))
    rank = np.repeat(first + (size + 1) / 2, size)
    p = int(y.sum())
    return float((rank[y[order] == 1].sum() - p * (p + 1) / 2) / (p * (len(y) - p)))


def ap_of(y: np.ndarray, s: np.ndarray) -> float:
    order = np.argsort(-s, kind="stable")
    tp = np.cumsum(y[order])
    last = np.append(s[order][1:] != s[order][:-1], True)
    tp, at = tp[last], np.flatnonzero(last) + 1
    return float((np.diff(np.concatenate([[0], tp])) * tp / at).sum() / y.sum())


def pairwise_significance(samples: DataFrame, model: str = "model", values: str = "samples") -> DataFrame:
    """model_a, model_b, p: min(1, 2 min(P(d <= 0), P(d >= 0))) of the aligned samples' differences.

    Samples that are NaN are dropped first, and the longer list is cut to the
    shorter: an unpaired approximation. Rows are models, not documents.
    """
    clean = samples.select(model, F.filter(values, lambda x: ~F.isnan(x) & x.isNotNull()).alias("v"))
    pairs = clean.toDF("model_a", "va").join(clean.toDF("model_b", "vb"), F.col("model_a") != F.col("model_b"))
    n = F.least(F.size("va"), F.size("vb"))
    d = pairs.select("model_a", "model_b", F.transform(F.arrays_zip(F.slice("va", F.lit(1), n), F.slice("vb", F.lit(1), n)), lambda x: x["0"] - x["1"]).alias("d"))
    size = F.size("d").cast("double")
    low, high = F.size(F.filter("d", lambda x: x <= 0)) / size, F.size(F.filter("d", lambda x: x >= 0)) / size
    return d.select("model_a", "model_b", F.when(size > 0, F.least(F.lit(1.0), 2 * F.least(low, high))).alias("p"))


def threshold_by_mcc(df: DataFrame, by: list[str], label: str, score: str, candidates: int = 200) -> DataFrame:
    """The score threshold of the largest MCC among interior quantiles of the scores; the first of equals wins.

    Each score is placed among its group's thresholds, candidates at most, and only counts of places meet.
    """
    grid = [k / (candidates + 1) for k in range(1, candidates + 1)]
    steps = score_steps(df, by, label, score)
    found = quantiles(usable(df, label, score), by, score, grid).groupBy(*by).agg(F.array_sort(F.array_distinct(F.collect_list("quantile"))).alias("c"))
    placed = steps.join(found, by) if by else steps.crossJoin(F.broadcast(found))  # one row
    counts = placed.groupBy(*by, F.size(F.filter("c", lambda t: t <= F.col("score"))).alias("b")).agg(F.sum("p").alias("p"), F.sum("n").alias("n"))
    cuts = found.select(*by, F.posexplode("c").alias("k", "threshold"))
    both = cuts.join(counts, by) if by else cuts.crossJoin(F.broadcast(counts))  # candidates + 1 rows at most
    above = F.col("b") > F.col("k")
    counts = both.groupBy(*by, "threshold").agg(*(F.sum(F.when(x, F.col(c)).otherwise(0)).alias(name) for name, x, c in (("tp", above, "p"), ("tn", ~above, "n"), ("fp", above, "n"), ("fn", ~above, "p"))))
    scored = counts.withColumn("mcc", mcc(*(F.col(c) for c in ("tp", "tn", "fp", "fn"))))
    best = F.max(F.struct(F.round("mcc", 12).alias("m"), (-F.col("threshold")).alias("t"), F.col("mcc").alias("mcc")))
    return scored.groupBy(*by).agg(best.alias("b")).select(*by, (-F.col("b.t")).alias("threshold"), F.col("b.mcc").alias("mcc"))


def evaluate(df: DataFrame, by: list[str], label: str = "true_interaction", score: str = "predicted_probability", predicted: str = "predicted_interaction") -> DataFrame:
    """Metrics and areas of every group of by."""
    counts = metrics(confusion(usable(df, label, score), by, label, predicted))
    area = areas(curve_counts(df, by, label, score), by)
    return counts.join(area, by)


def metric_udaf(df: DataFrame, by: list[str], label: str, score: str, function) -> DataFrame:
    """A metric callback (y, s) -> number over each group: the extension point for own metrics."""

    def one(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([{**{c: rows[c].iloc[0] for c in by}, "value": float(function(rows[label].to_numpy(), rows[score].to_numpy()))}])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*by).schema)
    return usable(df, label, score).select(*by, label, score).groupBy(*by).applyInPandas(one, f"{schema}, value double")
