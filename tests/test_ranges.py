"""Running totals, numbers, quantiles, curves and bootstraps over ranges: values, and that no task has a whole group."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftline.operators import evaluation, graph, ranges


@pytest.fixture
def spread(spark):
    """Small ranges: 8 of them, however few rows there are."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def rows_of(n, seed, models=("m",)):
    draw = np.random.default_rng(seed)
    return [(m, int(y), float(s)) for m in models for y, s in zip(draw.integers(0, 2, n), np.round(draw.normal(size=n) + 0.5, 2))]


def test_running_totals(spread):
    draw = np.random.default_rng(1)
    data = [(g, int(k), int(v)) for g in ("a", "b", None) for k, v in enumerate(draw.integers(0, 9, 50))]
    df = spread.createDataFrame(data, "g string, k int, v long").repartition(5)
    laid = ranges.Ranges(df, ["g"], ["-k"])
    assert laid.rows.groupBy("g").agg(F.countDistinct("_part").alias("n")).agg(F.min("n")).first()[0] > 1
    for r in laid.running(["v"], ahead=["v", "k"]).collect():
        own = {k: v for g, k, v in data if g == r.g}
        assert r.run_v == sum(v for k, v in own.items() if k >= r.k) and r.all_v == sum(own.values())
        assert (r.next_v, r.next_k) == ((own[r.k - 1], r.k - 1) if r.k else (None, None))
    got = ranges.numbered(df.select("v"), ["v"], "at").collect()
    assert sorted(r["at"] for r in got) == list(range(150)) and [r.v for r in sorted(got, key=lambda r: r["at"])] == sorted(v for *_, v in data)
    assert ranges.running_totals(df.limit(0), ["g"], ["k"], ["v"]).count() == 0


def test_quantiles(spread):
    data = rows_of(400, 3, ("a", "b")) + [("one", 1, 7.0), ("none", 1, None)]
    df = spread.createDataFrame(data, "g string, y int, v double")
    at = [0.0, 0.1, 0.5, 0.77, 1.0]
    got = {(r.g, r.k): r["quantile"] for r in ranges.quantiles(df, ["g"], "v", at).collect()}
    for g in ("a", "b", "one"):
        assert [got[g, k] for k in range(5)] == pytest.approx(np.quantile([v for h, _, v in data if h == g], at).tolist())
    assert ("none", 0) not in got
    plan = ranges.quantiles(df, ["g"], "v", at)._jdf.queryExecution().toString()
    assert "percentile" not in plan


def test_one_model_over_all_tasks(spread):
    df = spread.createDataFrame(rows_of(3000, 5), "m string, y int, s double")
    steps = ranges.Ranges(evaluation.score_steps(df, ["m"], "y", "s"), ["m"], ["-score"])
    assert steps.rows.select("_part").distinct().count() == 8
    counts = evaluation.curve_counts(df, ["m"], "y", "s")
    y, s = (np.array(x) for x in zip(*[(y, s) for _, y, s in rows_of(3000, 5)]))
    area = evaluation.areas(counts, ["m"]).first()
    assert area.roc_auc == pytest.approx(evaluation.auc_of(y, s)) and area.pr_ap == pytest.approx(evaluation.ap_of(y, s))
    points = sorted(((r.fpr, r.tpr) for r in evaluation.roc_points(counts, ["m"]).collect()))
    few = sorted(((r.fpr, r.tpr) for r in evaluation.roc_points(counts, ["m"], drop_collinear=True).collect()))
    kept = [points[0]] + [b for a, b, c in zip(points, points[1:], points[2:]) if abs((b[0] - a[0]) * (c[1] - b[1]) - (b[1] - a[1]) * (c[0] - b[0])) > 1e-15] + [points[-1]]
    assert few == kept


@pytest.mark.parametrize("metric", ["roc_auc", "pr_ap"])
def test_bootstrap_bounds(spread, metric):
    """Bounds agree with NumPy's resampling of rows to within a fifth of the interval's width."""
    data = rows_of(500, 7)
    df = spread.createDataFrame([(m, y, s + 0.4 * y) for m, y, s in data], "m string, y int, s double")
    got = evaluation.bootstrap(df, ["m"], "y", "s", metric, 1000).first()
    y, s = np.array([y for _, y, _ in data]), np.array([s + 0.4 * y for _, y, s in data])
    function = evaluation.auc_of if metric == "roc_auc" else evaluation.ap_of
    draw = np.random.default_rng(1)
    want = np.quantile([function(y[i], s[i]) for i in draw.integers(0, len(y), (1000, len(y)))], [0.025, 0.975])
    assert got.point == pytest.approx(function(y, s))
    assert abs(got.lo - want[0]) < 0.2 * np.diff(want)[0] and abs(got.hi - want[1]) < 0.2 * np.diff(want)[0]
    assert len(got.samples) == 1000 and np.std(got.samples) == pytest.approx(np.diff(want)[0] / 3.92, rel=0.2)
    again = evaluation.bootstrap(df.repartition(1), ["m"], "y", "s", metric, 1000).first()
    assert again.samples == pytest.approx(got.samples)  # of any partitions


def test_permuted_is_free_of_partitions(spark):
    data = [(f"k{i % 60}", f"v{i % 7}" if i % 3 else None) for i in range(400)]
    df = spark.createDataFrame(data, "k string, v string")
    one, many = (sorted(map(str, graph.permuted(df.repartition(n), "k", "v", 5).collect())) for n in (1, 7))
    assert one == many and one != sorted(map(str, df.collect()))
    assert sorted(map(str, graph.permuted(df, "k", "v", 6).collect())) != one
    lists = spark.createDataFrame([("a", ["x"]), ("b", ["y", "z"]), ("c", ["x"])], "k string, v array<string>")
    assert sorted(tuple(r.v) for r in graph.permuted(lists, "k", "v", 1).collect()) == [("x",), ("x",), ("y", "z")]
