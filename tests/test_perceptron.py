"""The perceptron's values: gradients, independence of partitions, copies and training over many blocks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftline.operators import models as M
from weftline.operators import perceptron as P


def test_gradient_equals_differences():
    draw = np.random.default_rng(3)
    sizes = [4, 5, 3, 1]
    w = draw.normal(size=sum(a * b + b for a, b in zip(sizes, sizes[1:])))
    z, y = draw.normal(size=(17, 4)), (draw.random(17) < 0.4).astype(float)
    got = P.gradient(P.shaped(w, sizes), z, y, 2.5, 0.0, draw)
    for k in range(len(w)):
        step = np.zeros_like(w)
        step[k] = 1e-6
        ends = [P.cross_entropy(P.shaped(w + s * step, sizes), z, y, 2.5) / len(y) for s in (1, -1)]
        assert got[k] == pytest.approx((ends[0] - ends[1]) / 2e-6, abs=1e-5)
    assert np.array_equal(P.flat(P.shaped(w, sizes)), w)


@pytest.fixture(scope="module")
def rings(spark):
    """Label 1 within a circle: no line separates them. A row has 40 copies."""
    at = lambda k: (F.pmod(F.xxhash64(F.lit(k), "id"), F.lit(2001)) / 1000.0 - 1).cast("float")
    rows = spark.range(1600).select("id", F.array(at(1), at(2)).alias("features")).withColumn("label", (F.col("features")[0] * F.col("features")[0] + F.col("features")[1] * F.col("features")[1] < 0.5).cast("int"))
    copies = rows.filter("id = 5").select(F.explode(F.array_repeat(F.struct("id", "features", "label"), 39)).alias("r")).select("r.*")
    return rows.unionByName(copies).drop("id").cache()


SETTING = {"hidden": [16], "rate": 0.02, "epochs": 30, "batch": 32, "dropout": 0.0}


def test_copies_keep_their_rows_and_moments_are_those_of_numpy(rings, monkeypatch):
    monkeypatch.setattr(P, "COPIES", 7)
    blocks = P.Blocks(rings, 100)
    assert blocks.rows.count() == rings.count() == 1639 and blocks.rows.select("id").distinct().count() == 1639
    assert blocks.blocks == -(-1639 // 50) > P.FAN_IN
    x = np.array([r.features for r in rings.collect()])
    fitted = P.train(blocks, [2], 0.01, 0, 0.0, 8, 1)
    assert np.allclose(fitted.mean, x.mean(0), atol=1e-12) and np.allclose(fitted.scale, x.std(0) + 1e-6, atol=1e-12)
    blocks.drop()


def test_learns_in_one_block_whatever_the_partitions(rings):
    model = M.NeuralNetwork()
    one, two = (model.fit(rings.repartition(k), SETTING, 4) for k in (1, 5))
    assert one.to_json() == two.to_json()
    assert M.average_precision(model.scored(one, rings)) > 0.97


def test_learns_over_blocks(rings):
    model = M.NeuralNetwork(1200)  # three blocks
    fitted = model.fit(rings, SETTING | {"epochs": 12, "rate": 0.05, "batch": 16}, 4)
    assert M.average_precision(model.scored(fitted, rings)) > 0.95
    one, two = (model.fit(rings.repartition(k), SETTING | {"epochs": 1}, 4) for k in (1, 5))
    assert one.to_json() == two.to_json()


def test_nothing_to_fit(rings):
    with pytest.raises(ValueError):
        M.NeuralNetwork().fit(rings.filter("label = 9"), SETTING, 1)
