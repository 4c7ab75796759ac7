"""Language model, language id, decontamination, sharding, quality and the pipeline."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
from conftest_llm import lower, space_words
from pyspark.sql import functions as F

import corpus_pipeline
from weftline.llm.decontaminate import WuManber, digest, find, remove_hits
from weftline.llm.elias_fano import QUANT, EliasFano, NgramTrie, dequantise
from weftline.llm.language_id import predict, prototypes
from weftline.llm.lm_scoring import score
from weftline.llm.quality import filter_documents, judge
from weftline.llm.sharding import shard_rows


def held(doc_id, mod):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % mod == 2


def test_elias_fano():
    draw = np.random.default_rng(0)
    for n, top in ((1, 10), (1000, 1 << 64), (5000, 6000), (0, 1), (3000, 1 << 20), (500, 501)):
        v = np.sort(draw.integers(0, top, n, dtype=np.uint64)) if n else np.zeros(0, np.uint64)
        e = EliasFano.encode(v, top)
        if n:
            x = np.concatenate([draw.integers(0, top, 500, dtype=np.uint64), v])
            assert (e[np.arange(n)] == v).all()
            assert (e.successor(x, np.zeros(len(x), np.int64), np.full(len(x), n)) == np.searchsorted(v, x)).all()


def test_trie_from_a_mapped_file(tmp_path):
    import mmap

    words = np.array([5, 9, 1 << 60], np.uint64)
    pairs = (np.array([0, 0, 2]), np.array([0, 2, 0]), np.array([3, 1, 2]))
    triples = (np.array([0, 2, 2]), np.array([1, 0, 2]), np.array([1, 2, 4]))
    trie = NgramTrie.build(words, np.array([4, 0, 2]), np.array([3, 8, (1 << 40) - 1], np.uint64), [pairs, triples])
    (tmp_path / "t").write_bytes(trie.dump())
    with open(tmp_path / "t", "rb") as f:
        trie = NgramTrie.load(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))
    assert trie.number(np.array([9, 7, 1 << 60], np.uint64)).tolist() == [1, -1, 2]
    assert trie.name(np.array([8, 7, (1 << 40) - 1], np.uint64)).tolist() == [1, -1, 2]
    assert trie.count(np.array([0, 1, 2, -1])).tolist() == [4, 0, 2, 0]
    two, three = trie.levels
    place = two.find(np.array([0, 2, 1, -1]), np.array([2, 1, 1, 1]), np.array([0, 2, 0, 0, 0]))
    assert place.tolist() == [0, 1, 2, -1, -1] and two.kinds(np.array([0, 1, -1])).tolist() == [2, 0, 0]
    assert np.allclose(dequantise(two.shares(place)), [3 / 6, 1 / 6, 2 / 3, 0, 0], rtol=1e-3)
    assert np.allclose(dequantise(two.left(np.array([0, 1, 2, -1]))), [2 / 6, 1, 1 / 3, 1], rtol=1e-3)
    place = three.find(np.array([0, 1, 2]), np.array([2, 1, 3]), np.array([0, 1, 1, 0, 1, 2]))
    assert place.tolist() == [-1, 0, -1, 1, -1, 2]
    assert np.allclose(dequantise(three.shares(place)), [0, 1 / 2, 0, 2 / 8, 0, 4 / 8], rtol=1e-3)
    assert np.allclose(dequantise(three.left(np.array([0, 1, 2]))), [1 / 2, 1, 2 / 8], rtol=1e-3)


def brute_lm(rows, order=3):
    tokens = [["<s>", *space_words(lower(t)), None] for _, t in rows]
    c, b = collections.Counter(), collections.defaultdict(collections.Counter)

    def contexts(w, k):
        return [tuple(w[k - n : k]) for n in range(1, min(order - 1, k) + 1)]

    for (d, _), w in zip(rows, tokens):
        if not held(d, 7):
            c.update(w[1:])
            for k in range(1, len(w)):
                for a in contexts(w, k):
                    b[a][w[k]] += 1
    sums = {a: sum(x.values()) for a, x in b.items()}
    n, v = sum(c.values()), len(c)
    out = []
    for (d, _), w in zip(rows, tokens):
        base = model = 0.0
        for k in range(1, len(w)):
            p = (c[w[k]] + 1) / (n + v + 1)
            base += math.log10(p)
            for a in contexts(w, k):
                if a in sums:
                    p = (b[a][w[k]] + len(b[a]) * p) / (sums[a] + len(b[a]))
            model += math.log10(p)
        out.append((d, held(d, 7), len(w) - 1, sum(c[x] > 0 for x in w[1:]), n, base, model))
    return out


def coded(tokens, order):
    """The most that the codes can move a score: half a step for each token and order above the first."""
    return tokens * (order - 1) * math.log10(2) / (2 * QUANT) + 1e-6


def test_lm_scores(odd, some, none):
    for df, order in ((odd, 3), (some, 3), (some, 2), (odd, 4)):
        learn = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 7 != 2
        got = sorted(map(tuple, score(df, learn, order=order)[0].collect()), key=str)
        want = sorted(brute_lm([(r.doc_id, r.text) for r in df.collect()], order), key=str)
        for g, w in zip(got, want, strict=True):
            assert g[:5] == w[:5] and math.isclose(g[5], w[5], rel_tol=1e-9) and abs(g[6] - w[6]) <= coded(w[2], order)
    assert score(none, F.lit(True))[0].count() == 0


def test_common_contexts_are_split(spark, some):
    """A context of a third of all pairs lies in several shards, and scores are those of the whole context."""
    from weftline.llm import lm_scoring

    rows = [(k, " ".join(f"the w{k * j % 97}" for j in range(1, 40)) + f" tail{k % 5}") for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = lm_scoring.common_contexts(docs.selectExpr("doc_id", "true AS learn", "text"), 1 << 20, 12)
    assert len(found[0]) and found[1].max() > 8
    for df, part in ((docs, 1 << 14), (some, 1 << 15)):
        learn = F.crc32(F.col("doc_id").cast("string")) % 7 != 2
        got = sorted(map(tuple, score(df, learn, shard_bytes=part)[0].collect()))
        want = sorted(brute_lm([(r.doc_id, r.text) for r in df.collect()]))
        for g, w in zip(got, want, strict=True):
            assert g[:5] == w[:5] and math.isclose(g[5], w[5], rel_tol=1e-9) and abs(g[6] - w[6]) <= coded(w[2], 3)


def test_language_id(spark, odd, none):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    names, profiles = prototypes(docs.filter(~out))
    got = predict(docs.filter(out), names, profiles).join(docs.select("doc_id", "lang"), "doc_id")
    assert got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97
    rows = {r.doc_id: r for r in predict(odd, names, profiles).collect()}
    assert rows[1].lang_pred == rows[2].lang_pred == "und" and rows[0].lang_pred in names and 0 <= rows[0].score <= 1
    assert predict(none, names, profiles).count() == 0 and prototypes(none)[0] == []
    assert {r.lang_pred for r in predict(odd, *prototypes(none)).collect()} == {"und"}


def alnum_words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))


def brute_hits(docs, items, size=10):
    windows = collections.defaultdict(set)
    for name, t in items:
        w = alnum_words(t)
        m = min(size, len(w))
        for j in range(len(w) - m + 1) if w else ():
            windows[tuple(w[j : j + m])].add("null" if name is None else str(name))
    out = []
    for d, t in docs:
        w, hit, names = alnum_words(t), set(), set()
        for m in {len(x) for x in windows}:
            for j in range(len(w) - m + 1):
                if own := windows.get(tuple(w[j : j + m])):
                    names |= own
                    hit |= set(range(j, j + m))
        out.append((d, len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)))
    return out


def test_decontamination(spark, odd, some, none):
    items = [(1, "One, two three four five SIX seven eight nine ten eleven twelve"), (2, "été"), (3, None), (4, "..."), (None, "foo"), (5, "of the"), (5, "x x x")]
    table = spark.createDataFrame(items, "item_id long, text string")
    for df in (odd, some):
        want = sorted(brute_hits([(r.doc_id, r.text) for r in df.collect()], items), key=str)
        for block in (4 << 20, 30):
            assert sorted(map(tuple, digest(find(df, table, block_bytes=block)).collect()), key=str) == want
    cut = {r.doc_id: r.text for r in remove_hits(find(odd, table)).collect()}
    assert cut[7] == "" and cut[9] == " changed" and cut[1] is None and cut[2] == ""
    assert digest(find(none, table)).count() == 0
    clean = spark.createDataFrame([], "item_id long, text string")
    assert digest(find(odd, clean)).filter("contaminated").count() == 0


def test_wu_manber_in_small_alphabets():
    draw = np.random.default_rng(3)
    for m in (1, 2, 3, 10):
        patterns = np.unique(draw.integers(0, 3, (20, m), dtype=np.uint64), axis=0)
        text = draw.integers(0, 3, 3000, dtype=np.uint64)
        last, which = WuManber(patterns).search(text, np.array([0, 1500]), np.array([1500, 3000]))
        want = {(i + m - 1, k) for k, p in enumerate(patterns) for i in range(3000 - m + 1) if (text[i : i + m] == p).all() and not i < 1500 <= i + m - 1}
        assert set(zip(last.tolist(), which.tolist())) == want and len(last) == len(want)


def shards(df, n, **kw):
    rows = df.withColumn("size", F.octet_length(F.coalesce("text", F.lit(""))) + 16)
    return shard_rows(rows, n, F.col("size"), F.col("text"), F.col("doc_id"), **kw)


def test_sharding(spark, odd, none):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").unionByName(spark.range(400).selectExpr("id + 5000 AS doc_id", "repeat('same ', 200) AS text", "'en' AS lang", "'s' AS source", "0L AS n_chars"))
    rows = shards(docs, 8).toPandas()
    size = rows.groupby("shard")["size"].sum()
    assert len(rows) == 1400 and size.max() < 1.03 * size.mean() + rows["size"].max() and size.min() > 0.97 * size.mean() - rows["size"].max()
    for _, own in rows.groupby("shard"):
        assert sorted(own.slot) == list(range(len(own)))
    texts = rows[rows.text.map(len) < 900].groupby("text").shard.nunique()
    assert (texts == 1).mean() > 0.98
    out = shards(odd, 3)
    assert out.count() == odd.count() and out.columns == [*odd.columns, "size", "shard", "slot"]
    assert shards(none, 3).count() == 0


def base_counts(t):
    w = space_words(t)
    tri = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    times = collections.Counter(tri)
    lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
    again = {p for i, x in enumerate(tri) if times[x] > 1 for p in (i, i + 1, i + 2)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(again)


def test_quality_counts_and_rules(odd, some, none):
    for df in (odd, some):
        judged = judge(df)
        assert judged.columns[: len(df.columns)] == df.columns or "_wf_x" in df.columns
        names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
        got = sorted(((r.doc_id, *(r[f"_wf_{n}"] for n in names), r._wf_base_failed) for r in judged.collect()), key=str)
        want = []
        for r in df.collect():
            b = base_counts(r.text)
            want.append((r.doc_id, *b, b[0] < 50 or 100 * b[4] > 50 * b[0]))
        assert got == sorted(want, key=str)
    assert filter_documents(some).columns == some.columns and filter_documents(none).count() == 0
    junk = judge(some).join(some.sparkSession.read.parquet("/root/testdata/sf0.001/labels.parquet"), "doc_id")
    assert junk.filter("quality = 1 AND NOT _wf_base_failed AND NOT _wf_kept").count() == 0
    assert junk.filter("quality = 0 AND _wf_kept").count() <= 2


def test_pipeline_stages(spark, some):
    sf = "/root/testdata/sf0.001"
    docs = some
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf).cache()
        assert out.columns == docs.columns, name
        assert 0 < out.count() <= docs.count()
        docs = out
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    assert not any(h[-1] for h in brute_hits([(r.doc_id, r.text) for r in docs.collect()], items))
    pieces = corpus_pipeline.run(spark, sf)
    assert pieces.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_pipeline_on_an_empty_table(spark, some):
    docs = some.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "/root/testdata/sf0.001")
        assert docs.count() == 0
