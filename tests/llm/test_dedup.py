"""Near dedup and line dedup against brute force."""

import collections
import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from conftest_llm import lower, space_words

from weftline.llm import line_dedup
from weftline.llm.line_dedup import dedup_lines
from weftline.llm.near_dedup import BINS, classes, keep_one, shingle_sets, signature
from weftline.llm.textkern import slices


def shingles(t, k):
    w = space_words(lower(t))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute_components(rows, k):
    sets = [shingles(t, k) for _, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
            up[find(i)] = find(j)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((d, len(sets[i]), min(ids, default=None) if sets[i] else d))
    return out


def order(rows):
    return sorted(rows, key=str)


def family(seed, groups, most):
    draw = random.Random(seed)
    rows, words = [], [f"w{i}" for i in range(400)]
    for g in range(groups):
        base = draw.choices(words, k=draw.randint(1, 60))
        for _ in range(draw.randint(1, most)):
            own = [draw.choice(words) if draw.random() < 0.04 else w for w in base]
            rows.append((len(rows) * 7 % 997, " ".join(own)))
    return rows


@pytest.mark.parametrize(("groups", "most", "k"), [(25, 6, 2), (2, 60, 5)])
def test_components_equal_brute_force(spark, groups, most, k):
    rows = family(groups, groups, most)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in classes(df, k).collect()]
    assert order(got) == order(brute_components(rows, k))


def test_hub_whose_copies_are_not_alike(spark):
    """Copies that are similar to their original but not to each other are found, though one bucket holds them all."""
    base = [f"v{i}" for i in range(300)]
    rows = [(500, " ".join(base))]
    for c in range(40):
        own = list(base)
        for j in range(14):
            own[(c * 17 + j * 20) % 300] = f"c{c}-{j}"
        rows.append((c, " ".join(own)))
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in classes(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()]
    assert order(got) == order(brute_components(rows, 2))


def test_every_link_of_a_real_table(spark):
    """Components of a whole table against an exact index of all shingles."""
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    sets = [shingles(t, 2) for _, t in rows]
    index, up = collections.defaultdict(list), list(range(len(rows)))

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for i, own in enumerate(sets):
        both = collections.Counter(j for x in own for j in index[x])
        for j, n in both.items():
            if 100 * n >= 80 * (len(own) + len(sets[j]) - n):
                up[find(i)] = find(j)
        for x in own:
            index[x].append(i)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(d, least.get(find(i), d))
    want = {d: (len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(rows)}
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in classes(df, 2).collect()}
    assert got == want and len(set(least.values())) < len(rows)


def test_odd_rows(odd, none):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    got = classes(odd, 2).collect()
    assert order((r.doc_id, r.n_shingles, r.component_id) for r in got) == order(brute_components(rows, 2))
    assert all(r.kept == (r.doc_id == r.component_id) for r in got if r.doc_id is not None)
    kept = keep_one(odd, 2)
    assert kept.columns == odd.columns
    assert order(r.doc_id for r in kept.collect()) == order(d for d in (0, 1, 2, 3, 4, 5, 6, 7, None, None))
    assert classes(none, 2).count() == 0 and keep_one(none).count() == 0


def test_signature_estimates_similarity():
    draw = np.random.default_rng(1)
    diffs = []
    for size in (12, 200, 3000):
        a = np.unique(draw.integers(0, 1 << 63, size, dtype=np.uint64) * np.uint64(2))
        b = np.unique(np.concatenate([a[: int(size * 0.9)], draw.integers(0, 1 << 63, size // 10, dtype=np.uint64)]))
        truth = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        diffs.append(abs((signature(a) == signature(b)).mean() - truth))
    assert max(diffs) < 0.15 and len(signature(np.array([3], np.uint64))) == BINS


def test_short_texts_are_one_shingle():
    s = next(slices(pa.array(["one two", "One  two", "one", "", None])))
    h, row = shingle_sets(s, 5)
    assert row.tolist() == [0, 1, 2] and h[0] == h[1] != h[2]


def line_words(line):
    return tuple(space_words(line.lower()))


def near(a, b, least):
    if a == b:
        return True
    if max(len(a), len(b)) < least or abs(len(a) - len(b)) > 1:
        return False
    n = min(len(a), len(b))
    front = next((i for i in range(n) if a[i] != b[i]), n)
    back = next((i for i in range(n) if a[-1 - i] != b[-1 - i]), n)
    return front + back >= max(len(a), len(b)) - 1


def brute_lines(rows, least=6):
    places = sorted((d, i, line_words(line)) for d, t in rows if t is not None for i, line in enumerate(t.split("\n")) if line_words(line))
    first = {}
    for d, i, w in places:
        first.setdefault(w, (d, i))
    by_place = sorted(first.items(), key=lambda x: x[1])
    gone = {w for k, (w, _) in enumerate(by_place) if any(near(w, v, least) for v, _ in by_place[:k])}
    keep = lambda d, i, w: not w or (w not in gone and first[w] == (d, i))
    return {d: None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if keep(d, i, line_words(x))) for d, t in rows}


def test_lines_equal_brute_force(spark):
    draw, rows, letters = random.Random(1), [], list("abcdefgh")
    for d in range(120):
        lines = []
        for _ in range(draw.randint(0, 5)):
            old = [x for x in rows if x[1]]
            if old and draw.random() < 0.4:
                w = draw.choice(draw.choice(old)[1].split("\n")).split(" ")
                k = draw.randrange(len(w))
                kind = draw.randrange(4)
                w = [w[:k] + w[k + 1 :], [*w[:k], draw.choice(letters), *w[k + 1 :]], [*w[:k], draw.choice(letters), *w[k:]], w][kind]
                lines.append(" ".join(w))
            else:
                lines.append(" ".join(draw.choices(letters, k=draw.randint(0, 12))))
        rows.append((d, "\n".join(lines)))
    rows[3], rows[4] = (3, None), (4, "")
    got = {r.doc_id: r.text for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_lines(rows)


def test_texts_that_lose_no_line_stay(spark, monkeypatch):
    """Only what may be met is moved; maps that tell nothing change no result."""
    rows = [(d, "\n".join(f"{'same' if d % 50 == 0 else d} line {k} of the text with {w} words" for k, w in enumerate("abc"))) for d in range(400)]
    own = spark.createDataFrame(rows, "doc_id long, text string")
    size = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = dedup_lines(own)
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        left = plan[: plan.rindex("Join")]
        assert "Union" in left and plan.count("getbit") == 2  # texts without a hit pass beside the join
        assert {r.doc_id: r.text for r in out.collect()} == brute_lines(rows)
        monkeypatch.setattr(line_dedup, "MAP_MOST", 1)
        monkeypatch.setattr(line_dedup, "MAP_WORDS", 1)
        assert {r.doc_id: r.text for r in dedup_lines(own).collect()} == brute_lines(rows)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", size)


def test_a_map_grows_with_its_keys(spark, monkeypatch):
    from weftline.llm.runtime import Scratch

    scratch, every = Scratch(spark), spark.range(20_000).select("id")
    few, many = line_dedup._Map(every.limit(100), scratch, "few"), line_dedup._Map(every, scratch, "many")
    assert (few.rows, many.rows) == (1, 20)
    assert many.met(every, ["id"]).count() == 20_000 and many.met(spark.range(20_000, 60_000), ["id"]).count() < 4_000


def test_lines_of_odd_rows(odd, none):
    out = dedup_lines(odd)
    assert out.columns == [*odd.columns, "_wf_lines", "_wf_removed"]
    got = sorted(((r.doc_id, r.text, r._wf_removed) for r in out.collect() if r.doc_id in (1, 2, 7, 8, 9)), key=str)
    text = "one two three four five six seven eight nine ten eleven"
    assert got == sorted([(1, None, 0), (2, "", 0), (7, text, 0), (8, "", 1), (8, "", 1), (9, "", 1)], key=str)
    assert out.count() == odd.count() and dedup_lines(none).count() == 0
