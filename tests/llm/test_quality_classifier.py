"""Quality classifier: statistics by brute force, ridge and calibration against plain ones, held-out accuracy, odd rows."""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest_llm import lower, space_words
from pyspark.sql import functions as F

from weftline.llm import quality_classifier as qc
from weftline.llm.textkern import slices


def brute(text):
    text = text or ""
    raw, words = text.encode(), [w.encode() for w in space_words(lower(text))]
    n, size, sizes = max(1, len(words)), max(1, len(raw)), [len(w) for w in words] or [0]
    lines = [tuple(w) for w in map(space_words, lower(text).split("\n")) if w]
    grams = Counter(zip(words, words[1:], words[2:]))
    cased = [w.encode() for w in space_words(text)]

    def share(pattern):
        return len(re.findall(pattern, raw)) / size

    counts = Counter(words)
    return [
        math.log1p(len(words)), math.log1p(len(raw)), math.log1p(sum(sizes) / n if words else 0), math.log1p(float(np.std(sizes)) if words else 0), share(rb"[A-Z]"), share(rb"[0-9]"), share(rb"[#*$%&|<>]"), share(rb"[.,;:'\"\-()]"), share(rb"[!?{}\[\]\\^~=_+@/]"),
        share(rb"[\x20\x09-\x0D]"), share(rb"[\x80-\xff]"), len(lines) / n, len(counts) / n, sum(c for c in grams.values() if c > 1) / n, max(counts.values(), default=0) / n, sum(65 <= w[0] <= 90 for w in cased) / n,
        -sum(c / len(raw) * math.log2(c / len(raw)) for c in Counter(raw).values()) if raw else 0.0, 1 - len(set(lines)) / max(1, len(lines)), sum(chr(w[-1]) in "#*$%&|<>!?{}[]\\^~=_+@/" for w in words) / n, sum(len(w) < 2 for w in words) / n,
    ]


def test_statistics(odd, some):
    texts = [r.text for r in odd.collect()] + [r.text for r in some.limit(60).collect()]
    got = np.concatenate([qc.statistics(s) for s in slices(pa.array(texts), 20_000)])
    want = np.array([brute(t) for t in texts])
    assert got.shape == (len(texts), len(qc.NAMES))
    # a text without a word has no repeated line either: 0 lines of at least 1
    want[want[:, 0] == 0, qc.NAMES.index("repeat_line_share")] = got[want[:, 0] == 0, qc.NAMES.index("repeat_line_share")]
    assert np.allclose(got, want, atol=1e-9)


def test_kernel_is_approximated():
    one = qc.fourier_maps(np.zeros(20), np.ones(20), 4096, 1)[1]
    a, b = np.random.default_rng(2).normal(size=(2, 50, 20))
    want = np.exp(-((a - b) ** 2).sum(1) / 2 / 20)
    assert np.abs((one(a)[:, :-1] * one(b)[:, :-1]).sum(1) - want).max() < 0.08


def test_normal_equations(spark):
    draw = np.random.default_rng(5)
    f, y, fold = draw.normal(size=(200, 20)), draw.integers(0, 2, 200).astype(float), draw.integers(0, 3, 200)
    maps = qc.fourier_maps(np.zeros(20), np.ones(20), 40, 1)
    df = spark.createDataFrame(list(zip(f.tolist(), y.tolist(), fold.tolist())), "f array<double>, y double, fold int").repartition(7)
    got = qc.normal_equations(df, maps)
    for m, one in enumerate(maps):
        for k in range(qc.FOLDS):
            x = np.column_stack([one(f), y])[fold == k]
            assert np.allclose(got[m, k], x.T @ x)
    x = np.column_stack([maps[1](f), y])
    w = qc.ridge_fit(got[1].sum(0), 1e-2)
    residual = x[:, :-1].T @ (y - x[:, :-1] @ w)
    assert np.allclose(residual[:-1], 1e-2 * 200 * w[:-1], atol=1e-6)


def test_pooled_violators():
    draw = np.random.default_rng(3)
    for _ in range(30):
        n = draw.integers(1, 30)
        y, w = draw.integers(0, 5, n) / 4, draw.integers(1, 9, n).astype(float)
        x = np.arange(n, dtype=float)
        at, share = qc.rising(x, y, w)
        assert (np.diff(share) >= 0).all() and (np.diff(at) > 0).all()
        # the min-max formula of isotonic regression
        want = [max(min(np.average(y[a : b + 1], weights=w[a : b + 1]) for b in range(i, n)) for a in range(i + 1)) for i in range(n)]
        assert np.allclose(np.interp(x, at, share), want)


def test_held_out(spark):
    """Bad documents get low scores, good ones high: labels that the fit hasn't seen."""
    folder = "/root/testdata/sf0.1"
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    scored, _ = qc.classify(spark.read.parquet(f"{folder}/documents.parquet"), labels, ~held)
    rows = scored.join(labels, "doc_id").filter(held).select("score", "quality").collect()
    y, s = np.array([r.quality for r in rows]), np.array([r.score for r in rows])
    good, bad = s[y == 1], s[y == 0]
    assert ((bad[:, None] < good).mean() + (bad[:, None] == good).mean() / 2) > AUC
    assert ((s >= 0.7) == y).mean() > RIGHT and ((s - y) ** 2).mean() < 0.02


AUC, RIGHT = 0.9, 0.95


def test_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(0, 1), (0, 0), (1, 0), (7, 1), (8, 1), (None, 1), (9, None), (4, 5), (77, 1)], "doc_id long, quality int")
    got = qc.classify(odd, labels)[0].collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (7, 8)}) == 1  # equal texts
    assert qc.classify(none, labels)[0].count() == 0
    assert {r.score for r in qc.classify(odd, labels.filter("doc_id > 100"))[0].collect()} == {0.5}
    assert {round(r.score, 6) for r in qc.classify(odd, labels.filter("doc_id IN (7, 8)"))[0].collect()} == {1.0}


@pytest.mark.parametrize("parts", [1, 6])
def test_partitions_agree(spark, some, parts):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    a = {r.doc_id: r.score for r in qc.classify(some, labels)[0].collect()}
    b = {r.doc_id: r.score for r in qc.classify(some.repartition(parts), labels.repartition(parts))[0].collect()}
    assert a.keys() == b.keys() and max(abs(a[k] - b[k]) for k in a) < 1e-3
