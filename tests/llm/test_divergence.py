"""Source divergence: against counting in Python, on odd rows and few kept terms."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest_llm import lower

from weftline.llm import divergence as dv


def brute(rows, least, prior, top):
    docs, groups, langs, terms = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter), {}
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        own = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower(text))
        groups[lang, source].update(own)
        docs[lang].update(set(own))
    out = []
    for lang in {k[0] for k in groups}:
        terms = sorted((t for t, n in docs[lang].items() if n >= least), key=lambda t: t.encode())
        sources = sorted(s for g, s in groups if g == lang)
        count = {s: [groups[lang, s][t] for t in terms] for s in sources}
        count[None] = [sum(c) for c in zip(*count.values())]
        share = {s: [1 + 10**9 * (n + prior) // (sum(c) + prior * len(terms)) for n in c] for s, c in count.items()}
        for s in sources:
            pairs = [(o, sum(abs(a - b) for a, b in zip(share[s], share[o]))) for o in sources if o != s]
            used = [(t, a - b) for t, n, a, b in zip(terms, count[s], share[s], share[None]) if n and a > b]
            for part, found in (("pair", pairs), ("term", used)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, t, v, k + 1) for k, (t, v) in enumerate(found) if part == "pair" or k < top]
    return sorted(out)


def check(spark, df, least, prior=5, top=50, **more):
    got = sorted(tuple(r) for r in dv.divergence(df, least, prior, top).collect())
    assert got == brute(df.select("text", "lang", "source").collect(), least, prior, top)
    return got


def test_real_rows(spark, some):
    assert check(spark, some, 5, top=7)


@pytest.mark.parametrize("least", [1, 2, 10_000])
def test_odd_rows(spark, odd, none, least):
    got = check(spark, odd, least)
    assert any(r[2] == "pair" for r in got)
    assert dv.divergence(none, least).count() == 0


def test_blocks_and_strips(spark, some, monkeypatch):
    monkeypatch.setattr(dv, "CELLS", 500)
    monkeypatch.setattr(dv, "LEAST_TERMS", 10)
    monkeypatch.setattr(dv, "STRIP", 3)
    check(spark, some, 3)


def test_lengths_and_ties(spark):
    words = ["A" * 8, "a" * 9, "é" * 4, "é" * 5, "b" * 16, "B" * 17, "c" * 5000, "c" * 5000 + "d", "Ünï", "日本語テスト日本語テスト", "x1y", "\x7fz"]
    rows = [(" ".join(words[k:] + words[: k // 2]), "l", f"s{k % 3}") for k in range(len(words))] * 2
    check(spark, spark.createDataFrame(rows, "text string, lang string, source string").repartition(4), 2)


def test_radix_order():
    draw = np.random.default_rng(1)
    a, b = draw.integers(0, 5, 1000).astype(np.uint64) << np.uint64(60), draw.integers(0, 1 << 63, 1000).astype(np.uint64)
    assert (dv.radix_order([a, b]) == np.lexsort((b, a))).all()
    assert dv.radix_order([a[:0]]).tolist() == []


def test_shares_beyond_64_bits():
    counts = [0, 3, 10**13, 7 * 10**14]
    assert dv.share(np.array(counts), 10**15, 5, 1000).tolist() == [1 + 10**9 * (c + 5) // (10**15 + 5000) for c in counts]


def test_share_column(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([(0, 10**15, 1000), (10**15 - 5, 10**15, 0), (3, 0, 0)], "c long, n long, v long")
    got = [r[0] for r in rows.select(dv._share(F.col("c"), F.col("n") + 5, 5, F.col("v"))).collect()]
    assert got == [1 + 10**9 * (c + 5) // (n + 5 + 5 * v) for c, n, v in rows.collect()]
