"""Near-duplicate documents: one-permutation MinHash, banded buckets, star edges.

1. Each text becomes its set of word shingles. One permutation splits the hash
   range into bins; a bin's minimum is a signature value, and an empty bin
   takes that of the first filled bin in an order of its own (optimal
   densification). Bands of the signature are bucket keys.
2. Texts with equal sets are one class from here on, summed where they are read.
3. In a bucket, the class that shares most bucket places with others is the
   centre, and candidates are the edges from it: a star, so edges grow with the
   bucket and not with its square.
4. Candidates are confirmed on the full sets, and components of the confirmed
   links are found by randomised contraction, in rounds that grow with the
   logarithm of a chain.
5. Where a bucket still holds several components, what its star doesn't see is
   looked up too. Small buckets compare classes of different components. In a
   large one, each class outside its largest component is a probe against that
   component, and against the other classes outside it: the targets' sets lie
   in chunks with an inverted index, and a probe counts its intersections with
   a whole chunk at once. Rows that move are probes times chunks; no pair is
   emitted unless it is a link.

With 32 bands of 4, a pair of similarity 0.8 shares no bucket with a chance of
5e-8 if bins were independent; densified bins of small sets repeat each other,
so for those it is larger. Exact comparisons with an index of all sets are in
the tests. Nulls and empties: a text without words has an empty set and is linked
with nothing. A class is known by a 64-bit fingerprint of its set. Rows with a
null doc_id are linked like others but never name a component; if all rows of
a component are without id, its component_id is null and they are kept. Rows
that repeat a doc_id are judged by it alike. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.graph import connected_components
from .runtime import Scratch, fresh, quoted, spread_join
from .textkern import NON_SPACE, Slice, combine, mix, slices, spread

BINS = 128
SMALL = 16
CHUNK = 128


def shingle_sets(s: Slice, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each row, ascending, and the row of each."""
    at, end, doc = s.words(NON_SPACE)
    h = s.hashes(at, end)
    n = len(h)
    if n >= size:
        whole = doc[: n - size + 1] == doc[size - 1 :]
        shingle = combine(*(h[k : n - size + 1 + k][whole] for k in range(size)))
        row = doc[: n - size + 1][whole]
    else:
        shingle, row = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    count = np.bincount(doc, minlength=len(s))
    few = np.flatnonzero((count > 0) & (count < size))
    if len(few):
        edge = np.searchsorted(doc, few)
        short = [combine(np.array([len_of], np.uint64), *(h[e + k : e + k + 1] for k in range(len_of)))[0] for e, len_of in zip(edge.tolist(), count[few].tolist())]
        shingle, row = np.concatenate([shingle, np.array(short, np.uint64)]), np.concatenate([row, few])
    order = np.lexsort((shingle, row))
    shingle, row = shingle[order], row[order]
    new = np.ones(len(row), bool)
    new[1:] = (shingle[1:] != shingle[:-1]) | (row[1:] != row[:-1])
    return shingle[new], row[new]


def _orders() -> np.ndarray:
    """rank[i, b]: when bin i, if empty, would ask bin b; a bin asks itself first."""
    pairs = np.arange(BINS * BINS, dtype=np.uint64).reshape(BINS, BINS)
    rank = mix(pairs + np.uint64(1 << 40)).argsort(axis=1).argsort(axis=1)
    rank[np.arange(BINS), np.arange(BINS)] = -1
    return rank


_RANK = _orders()


def signature(own: np.ndarray) -> np.ndarray:
    """One-permutation MinHash of an ascending set of hashes, densified."""
    spot = (own >> np.uint64(57)).astype(np.int64)
    first = np.ones(len(own), bool)
    first[1:] = spot[1:] != spot[:-1]
    values = own[first]
    return values if first.sum() == BINS else values[_RANK[:, spot[first]].argmin(axis=1)]


def band_keys(sig: np.ndarray, bands: int) -> np.ndarray:
    parts = sig.reshape(bands, -1)
    return combine(np.arange(bands, dtype=np.uint64), *parts.T)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _prints(shingle: np.ndarray, edge: np.ndarray) -> np.ndarray:
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(shingle ^ np.uint64(0x5BF0363546294CE7)))])
    return _signed(mix(sums[edge[1:]] - sums[edge[:-1]] + (edge[1:] - edge[:-1]).astype(np.uint64)))


def signatures(docs: DataFrame, size: int, bands: int) -> DataFrame:
    """doc_id, t, n (set size), node (the set's fingerprint) and bands of each row of (doc_id, t, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in slices(batch.column(2)):
                shingle, row = shingle_sets(s, size)
                edge = np.searchsorted(row, np.arange(len(s) + 1))
                keys = [_signed(band_keys(signature(shingle[a:z]), bands)) if z > a else None for a, z in zip(edge[:-1].tolist(), edge[1:].tolist())]
                yield pa.record_batch(
                    [batch.column(0).slice(s.first, len(s)), batch.column(1).slice(s.first, len(s)), pa.array(np.diff(edge)), pa.array(_prints(shingle, edge)), pa.array(keys, pa.list_(pa.int64()))],
                    names=["doc_id", "t", "n", "node", "bands"],
                )

    return docs.mapInArrow(run, "doc_id long, t long, n long, node long, bands array<long>")


def full_sets(docs: DataFrame, size: int) -> DataFrame:
    """node and set (its hashes, ascending) of each row of (text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in slices(batch.column(0)):
                shingle, row = shingle_sets(s, size)
                edge = np.searchsorted(row, np.arange(len(s) + 1))
                offsets = pa.py_buffer((edge * 8).astype(np.int64))
                sets = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(s), [None, offsets, pa.py_buffer(shingle)])
                yield pa.record_batch([pa.array(_prints(shingle, edge)), sets.cast(pa.binary())], names=["node", "set"])

    return docs.mapInArrow(run, "node long, set binary")


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union on their full sets.

    Each b's set travels once for each of its centres, a centre's set once for
    CHUNK of its pairs.
    """
    degree = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("d"))
    salted = pairs.join(degree, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.ceil(F.col("d") / CHUNK)).cast("int").alias("salt"))
    member = salted.join(sets, salted.b == sets.node).select("a", "salt", F.lit(1).alias("role"), "b", "set")
    centre = salted.select("a", "salt").distinct().join(sets, F.col("a") == sets.node).select("a", "salt", F.lit(0).alias("role"), F.col("a").alias("b"), "set")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, own = None, None
        for batch in batches:
            a, salt, role, b = (batch.column(k).to_numpy() for k in range(4))
            good = []
            for k, blob in enumerate(batch.column(4)):
                other = np.frombuffer(blob.as_buffer(), np.uint64)
                if role[k] == 0:
                    now, own = (a[k], salt[k]), other.copy()
                elif now == (a[k], salt[k]):
                    x, y = (own, other) if len(own) < len(other) else (other, own)
                    at = np.searchsorted(y, x)
                    both = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                    if 100 * both >= percent * (len(own) + len(other) - both):
                        good.append(k)
            yield pa.record_batch([pa.array(a[good]), pa.array(b[good])], names=["a", "b"])

    rows = member.unionByName(centre).repartition("a", "salt").sortWithinPartitions("a", "salt", "role")
    return rows.mapInArrow(run, "a long, b long")


def probed(probes: DataFrame, targets: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) of each probe (unit, node) with the targets (unit, node) of its unit; both are written tables."""
    chunks = targets.groupBy("unit").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("k"))
    laid = spread_join(targets, chunks, ["unit"]).select("unit", F.pmod(F.xxhash64("node"), F.col("k")).cast("int").alias("chunk"), F.lit(0).alias("role"), "node")
    asked = spread_join(probes, chunks, ["unit"]).select("unit", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("chunk"), F.lit(1).alias("role"), "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, nodes, own, index = None, [], [], None
        for batch in batches:
            unit, chunk, role, node = (batch.column(k).to_numpy() for k in range(4))
            a, b = [], []
            for k, blob in enumerate(batch.column(4)):
                if now != (unit[k], chunk[k]):
                    now, nodes, own, index = (unit[k], chunk[k]), [], [], None
                other = np.frombuffer(blob.as_buffer(), np.uint64)
                if role[k] == 0:
                    nodes.append(node[k])
                    own.append(other.copy())
                    continue
                if not own:
                    continue
                if index is None:
                    size = np.array(list(map(len, own)))
                    flat, who = np.concatenate(own), np.repeat(np.arange(len(own)), size)
                    order = np.argsort(flat, kind="stable")
                    keys, first = np.unique(flat[order], return_index=True)
                    index = keys, np.append(first, len(flat)), who[order], size, np.array(nodes)
                keys, first, who, size, names = index
                at = np.minimum(np.searchsorted(keys, other), len(keys) - 1)
                at = at[keys[at] == other]
                both = np.bincount(who[spread(first[at], first[at + 1] - first[at])], minlength=len(size))
                hit = (100 * both >= percent * (size + len(other) - both)) & (names != node[k])
                a += [node[k]] * int(hit.sum())
                b += names[hit].tolist()
            yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    rows = laid.unionByName(asked).join(sets, "node").select("unit", "chunk", "role", "node", "set")
    return rows.repartition("unit", "chunk").sortWithinPartitions("unit", "chunk", "role").mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """node and comp (the smallest node reachable) of each end of edges (a, b)."""
    return connected_components(edges).withColumnRenamed("component", "comp")


def classes(docs: DataFrame, size: int = 5, percent: int = 80, bands: int = 32, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, t (the text's hash), n_shingles, component_id, kept."""
    scratch = Scratch(docs.sparkSession)
    text = F.col(quoted(text_col))
    texts = docs.select(F.col(quoted(id_col)).cast("long").alias("doc_id"), F.xxhash64(text).alias("t"), text.alias("text"))
    sig = scratch.table(signatures(texts, size, bands), "signatures")
    filled = sig.filter("n > 0")
    groups = scratch.table(filled.groupBy("node").agg(F.min("doc_id").alias("least"), F.min("t").alias("t"), F.max("n").alias("n"), F.count(F.lit(1)).alias("rows")), "classes")

    # Of each class, the row of its least doc_id stands for it.
    one = filled.join(groups.select("node", "least"), ["node"]).filter(F.col("doc_id").eqNullSafe(F.col("least"))).select("node", "n", "bands").dropDuplicates(["node"])
    places = scratch.table(one.select("node", "n", F.explode("bands").alias("key")), "places")
    sizes = places.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    shared = scratch.table(places.join(sizes, "key"), "shared")
    score = scratch.table(shared.groupBy("node").agg(F.sum("size").alias("score")), "scores")
    buckets = scratch.table(shared.join(score, "node"), "buckets")
    scratch.drop("places", "shared")

    # Full sets, of classes in shared buckets only.
    wanted = score.join(groups, "node").select(F.col("least"), F.col("node").alias("want"))
    some = filled.select("doc_id", "t", "node").join(wanted, (F.col("node") == F.col("want")) & F.col("doc_id").eqNullSafe(F.col("least"))).groupBy("want").agg(F.min("t").alias("t"), F.min("doc_id").alias("least"))
    chosen = texts.alias("d").join(some.alias("w"), (F.col("d.t") == F.col("w.t")) & F.col("d.doc_id").eqNullSafe(F.col("w.least")), "left_semi").select("d.text")
    sets = scratch.table(full_sets(chosen, size).dropDuplicates(["node"]), "sets")

    fits = f"a != node AND 100 * least(n, an) >= {percent} * greatest(n, an)"
    heads = scratch.table(buckets.groupBy("key").agg(F.max(F.struct("score", "node", "n")).alias("c")).select("key", F.col("c.node").alias("a"), F.col("c.n").alias("an")), "heads")
    pairs = scratch.table(buckets.join(heads, "key").filter(fits).select("a", F.col("node").alias("b")).distinct(), "pairs")
    stars = scratch.table(confirm(pairs, sets, percent), "stars")
    comps = components(stars)

    placed = buckets.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    mixed = placed.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo != hi").select("key")
    live = scratch.table(placed.filter("size > 2").join(mixed, "key", "left_semi"), "live")
    # Small buckets: classes of different components, but for the centre, which met all.
    few = live.filter(f"size <= {SMALL}").join(heads.select("key", F.col("a").alias("head")), "key").filter("node != head")
    each = few.select("key", F.col("node").alias("a"), F.col("n").alias("an"), F.col("comp").alias("ac"))
    more = few.join(each, "key").filter(f"a < node AND ac != comp AND {fits}").select("a", F.col("node").alias("b")).distinct()
    more = scratch.table(more.join(pairs, ["a", "b"], "left_anti").join(pairs.toDF("b", "a"), ["a", "b"], "left_anti"), "more")
    # Large buckets: probes outside the bucket's largest component against it, and against each other.
    many = live.filter(f"size > {SMALL}")
    top = many.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("k")).groupBy("key").agg(F.max(F.struct("k", "comp"))["comp"].alias("top"))
    outside = scratch.table(many.join(top, "key").filter("comp != top").select("key", "node", "top"), "outside")
    asked = outside.select(F.xxhash64(F.lit("c"), F.col("top")).alias("unit"), "node").distinct()
    wanted = outside.select("top").distinct()
    inside = placed.select("node", "comp").distinct().join(wanted, F.col("comp") == F.col("top"), "left_semi").select(F.xxhash64(F.lit("c"), F.col("comp")).alias("unit"), "node")
    others = outside.select(F.xxhash64(F.lit("k"), F.col("key")).alias("unit"), "node")
    probes, targets = scratch.table(asked.unionByName(others), "probes"), scratch.table(inside.unionByName(others), "targets")
    rest = probed(probes, targets, sets, percent)
    found = scratch.table(confirm(more, sets, percent).unionByName(rest), "found")
    links = stars.unionByName(found)
    comps = components(links)

    placed = groups.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    named = placed.groupBy("comp").agg(F.min("least").alias("component_id"), F.sum("rows").alias("rows")).filter("rows > 1")
    label = scratch.table(placed.select("node", "comp").join(named, "comp").select("node", "component_id"), "labels")
    scratch.drop("buckets", "sets", "classes", "scores", "heads", "pairs", "stars", "live", "more", "outside", "probes", "targets", "found")
    out = sig.select("doc_id", "t", "n", F.when(F.col("n") > 0, F.col("node")).alias("node")).join(label, "node", "left")
    comp = F.when(label["node"].isNotNull(), F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "t", F.col("n").alias("n_shingles"), comp.alias("component_id"), F.coalesce(F.col("doc_id") == comp, comp.isNull()).alias("kept"))


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stand for their component, with docs' columns."""
    doc, t = fresh(docs.columns, "_wf_doc", "_wf_t")
    gone = classes(docs, size, percent, id_col=id_col, text_col=text_col).filter("NOT kept").select(F.col("doc_id").alias(doc), F.col("t").alias(t)).distinct()
    on = F.col(quoted(id_col)).cast("long").eqNullSafe(F.col(doc)) & (F.xxhash64(F.col(quoted(text_col))) == F.col(t))
    return docs.join(gone, on, "left_anti")
