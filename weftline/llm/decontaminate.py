"""Benchmark decontamination by Wu-Manber search, with words as symbols.

Each benchmark window is a pattern of words. A shift table, indexed by the hash
of a block of two words, tells how far the search may jump: most positions of a
text are never looked at. Where the shift is 0, the block is the suffix of some
patterns; their bucket is compared word by word with the text (first the
prefix block, then all words, each by its 64-bit hash). Many lanes, stretches
of documents, advance side by side in arrays.

The patterns of a block of items go to every task; a block has a bound in bytes,
and further blocks are searched one after another, so what is sent has a fixed
bound however large the benchmark is.

Nulls and empties: a null text has no words and no hits; an item of no words
has no window; items with a null id are one item, shown as `null`; repeated
items count once, repeated documents are searched each. With an empty
benchmark nothing is hit; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import itertools
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .runtime import Scratch, fresh, neutral, quoted
from .textkern import ALNUM, Slice, slices, spread

LANE = 512
_K = np.uint64(0x9E3779B97F4A7C15)


class WuManber:
    """Patterns of one length m over 64-bit symbols."""

    def __init__(self, patterns: np.ndarray) -> None:
        self.patterns = patterns
        n, self.m = patterns.shape
        self.b = min(2, self.m)
        top = self.m - self.b + 1
        self.bits = int(min(22, max(12, np.ceil(np.log2(8 * n * top)))))
        self.shift = np.full(1 << self.bits, min(top, 255), np.uint8)
        for j in range(self.b, self.m + 1):
            np.minimum.at(self.shift, self._block(patterns, j - 1), min(self.m - j, 255))
        suffix = self._block(patterns, self.m - 1)
        self.order = np.argsort(suffix, kind="stable")
        self.bucket = np.searchsorted(suffix[self.order], np.arange((1 << self.bits) + 1))

    def _block(self, rows: np.ndarray, at: int) -> np.ndarray:
        return self._hash(rows[:, at - 1] if self.b == 2 else None, rows[:, at])

    def _hash(self, before: np.ndarray | None, last: np.ndarray) -> np.ndarray:
        x = last if before is None else last + before * _K
        return ((x * _K) >> np.uint64(64 - self.bits)).astype(np.int64)

    def search(self, h: np.ndarray, first: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Last position and pattern of each occurrence inside the stretches h[first:stop]."""
        # A lane holds up to LANE end positions of one stretch.
        ends = np.maximum(stop - first - self.m + 1, 0)
        lanes = -(-ends // LANE)
        row = np.repeat(np.arange(len(first)), lanes)
        pos = first[row] + self.m - 1 + LANE * spread(np.zeros(len(lanes), np.int64), lanes)
        limit = np.minimum(pos + LANE, stop[row])
        found = []
        while len(pos):
            step = self.shift[self._hash(h[pos - 1] if self.b == 2 else None, h[pos])].astype(np.int64)
            zero = step == 0
            if zero.any():
                found.append(pos[zero])
            pos = pos + np.maximum(step, 1)
            live = pos < limit
            pos, limit = pos[live], limit[live]
        at = np.concatenate(found) if found else np.zeros(0, np.int64)
        hits, which = [], []
        for lo in range(0, len(at), 65536):
            p = at[lo : lo + 65536]
            block = self._hash(h[p - 1] if self.b == 2 else None, h[p])
            count = self.bucket[block + 1] - self.bucket[block]
            upto = np.cumsum(count)
            a = 0
            while a < len(p):  # buckets are compared in steps of bounded size
                z = max(a + 1, int(np.searchsorted(upto, (upto[a - 1] if a else 0) + (1 << 19), side="right")))
                pair = np.repeat(p[a:z], count[a:z])
                pat = self.order[spread(self.bucket[block[a:z]], count[a:z])]
                for j in (0, *range(min(1, self.m - 1), self.m)):
                    same = h[pair - self.m + 1 + j] == self.patterns[pat, j]
                    pair, pat = pair[same], pat[same]
                hits.append(pair)
                which.append(pat)
                a = z
        none = np.zeros(0, np.int64)
        return (np.concatenate(hits), np.concatenate(which)) if hits else (none, none)


def item_windows(s: Slice, window: int) -> list[tuple[int, np.ndarray]]:
    """(row of s, its window's word hashes) for each window."""
    at, end, doc = s.words(ALNUM)
    h = s.hashes(at, end)
    edge = np.searchsorted(doc, np.arange(len(s) + 1))
    out = []
    for k in range(len(s)):
        own = h[edge[k] : edge[k + 1]]
        if len(own):
            m = min(window, len(own))
            out += [(k, own[j : j + m]) for j in range(len(own) - m + 1)]
    return out


def _shown(name: str | None) -> tuple[str, bool]:
    """Order of item ids as text; an item without id is shown as null, after one that is called so."""
    return ("null", True) if name is None else (name, False)


class Matcher:
    """All windows of a block of items: one search for each length of window."""

    def __init__(self, items: list[tuple[str | None, str]], window: int) -> None:
        by_length: dict[int, dict[bytes, set[int]]] = defaultdict(lambda: defaultdict(set))
        self.names = sorted({name for name, _ in items}, key=_shown)
        number = {name: k for k, name in enumerate(self.names)}
        for s in slices(pa.array([text for _, text in items], pa.string())):
            for k, w in item_windows(s, window):
                by_length[len(w)][w.tobytes()].add(number[items[s.first + k][0]])
        self.searches = []
        for m, found in sorted(by_length.items()):
            patterns = np.frombuffer(b"".join(found), np.uint64).reshape(-1, m)
            owners = list(map(sorted, found.values()))
            starts = np.cumsum([0, *map(len, owners)])
            self.searches.append((WuManber(patterns), np.array([x for o in owners for x in o], np.int64), starts))

    def match(self, s: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For the words of s: their rows, starts and ends, which are hit, and the (row, item) pairs as rows of an array."""
        at, end, doc = s.words(ALNUM)
        h = s.hashes(at, end)
        edge = np.searchsorted(doc, np.arange(len(s) + 1))
        cover = np.zeros(len(h) + 1, np.int64)
        pairs = [np.zeros((0, 2), np.int64)]
        for search, owners, starts in self.searches:
            last, pattern = search.search(h, edge[:-1], edge[1:])
            np.add.at(cover, last - search.m + 1, 1)
            np.add.at(cover, last + 1, -1)
            known = np.unique(np.stack([doc[last], pattern], 1), axis=0) if len(last) else np.zeros((0, 2), np.int64)
            count = starts[known[:, 1] + 1] - starts[known[:, 1]]
            pairs.append(np.stack([np.repeat(known[:, 0], count), owners[spread(starts[known[:, 1]], count)]], 1))
        return doc, at, end, np.cumsum(cover[:-1]) > 0, np.unique(np.concatenate(pairs), axis=0)


def _blocks(items: DataFrame, id_col: str, text_col: str, limit_bytes: int) -> Iterator[list[tuple[str | None, str]]]:
    """The items in blocks of bounded size, streamed partition by partition."""
    block, size = [], 0
    rows = items.select(F.col(quoted(id_col)).cast("string"), F.coalesce(F.col(quoted(text_col)), F.lit("")))
    for name, text in rows.toLocalIterator():
        if block and size + len(text) > limit_bytes:
            yield block
            block, size = [], 0
        block.append((name, text))
        size += len(text) + 16
    if block:
        yield block


def _matched(matcher: Matcher, s: Slice) -> tuple[np.ndarray, list[bytes | None], list[list]]:
    """For each row of s: words, a bit for each word (None where none is hit) and the items, sorted as text."""
    doc, _, _, hit, pairs = matcher.match(s)
    n = np.bincount(doc, minlength=len(s))
    edge = np.concatenate([[0], np.cumsum(n)])
    got = defaultdict(list)
    for row, item in pairs.tolist():
        got[row].append(matcher.names[item])
    rows = set(doc[hit].tolist())
    bits = [np.packbits(hit[edge[k] : edge[k + 1]]).tobytes() if k in rows else None for k in range(len(s))]
    return n, bits, [got.get(k, []) for k in range(len(s))]


def find(docs: DataFrame, items: DataFrame, window: int = 10, block_bytes: int = 4 << 20, text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """docs with _wf_n_words, _wf_hits (a bit for each word), _wf_items (sorted item ids as strings, null for an item without id).

    The three columns are the last, with underscores behind their names where
    docs has one of that name. block_bytes: the text of the items that are
    searched, and sent, at once. The documents are read once for each further
    block, but carried along only once: what a block finds is kept by the
    text's hash, and joined in the end.
    """
    rows, name = neutral(docs)
    inner = rows.columns
    place = inner.index(name[text_col])
    out = [*docs.columns, *fresh(docs.columns, "_wf_n_words", "_wf_hits", "_wf_items")]
    blocks = _blocks(items, item_id, item_text, block_bytes)
    first, second = next(blocks, []), next(blocks, None)
    added = "n_words long, hits binary, items array<string>"

    def step(block: list[tuple[str | None, str]], carried: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(block, window)
            for batch in batches:
                for s in slices(batch.column(place if carried else 0)):
                    part = batch.slice(s.first, len(s))
                    n, bits, names = _matched(matcher, s)
                    kept = range(len(s)) if carried else [k for k, b in enumerate(bits) if b is not None]
                    head = part.columns if carried else [part.column(1).take(pa.array(kept, pa.int64()))]
                    columns = [*head, pa.array(n.astype(np.int64)[list(kept)]), pa.array([bits[k] for k in kept], pa.binary()), pa.array([names[k] for k in kept], pa.list_(pa.string()))]
                    yield pa.RecordBatch.from_arrays(columns, names=[*(inner if carried else ["t"]), "n_words", "hits", "items"])

        return run

    schema = T.StructType([*rows.schema.fields, *T._parse_datatype_string(added).fields])
    if second is None:
        return rows.mapInArrow(step(first, True), schema).toDF(*out)
    scratch = Scratch(docs.sparkSession)
    texts = rows.select(F.col(name[text_col]).alias("text"), F.xxhash64(name[text_col]).alias("t"))
    parts = []
    for k, block in enumerate(itertools.chain((first, second), blocks)):
        parts.append(scratch.table(texts.mapInArrow(step(block, False), f"t long, {added}"), f"hits{k}").dropDuplicates(["t"]))
    every = reduce(lambda a, b: a.unionByName(b), parts)

    def merged(keys, group):  # a row for each block at most
        bits = np.bitwise_or.reduce([np.frombuffer(b, np.uint8) for b in group.column("hits").to_pylist()])
        names = sorted({x for own in group.column("items").to_pylist() for x in own}, key=_shown)
        return pa.table({"t": pa.array([keys[0].as_py()], pa.int64()), "hits": pa.array([bits.tobytes()], pa.binary()), "items": pa.array([names], pa.list_(pa.string()))})

    found = scratch.table(every.select("t", "hits", "items").groupBy("t").applyInArrow(merged, "t long, hits binary, items array<string>"), "found")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in slices(batch.column(place)):
                n = np.bincount(s.words(ALNUM)[2], minlength=len(s))
                yield pa.RecordBatch.from_arrays([*batch.slice(s.first, len(s)).columns, pa.array(n.astype(np.int64))], names=[*inner, "n_words"])

    counted = rows.mapInArrow(count, T.StructType([*rows.schema.fields, T.StructField("n_words", T.LongType())]))
    joined = counted.withColumn("t", F.xxhash64(name[text_col])).join(found, "t", "left")
    return joined.select(*inner, "n_words", "hits", F.coalesce("items", F.array().cast("array<string>"))).toDF(*out)


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """For each document of find(): doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = [int(np.unpackbits(np.frombuffer(b, np.uint8)).sum()) if b else 0 for b in batch.column(2).to_pylist()]
            items = batch.column(3).to_pylist()
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(hits, pa.int64()), pa.array([len(x) for x in items], pa.int64()), pa.array([hashlib.sha256(",".join("null" if y is None else y for y in x).encode()).hexdigest() for x in items]), pa.array([n > 0 for n in hits])],
                names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
            )

    schema = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
    return found.select(F.col(quoted(id_col)).cast("long").alias("doc_id"), *map(quoted, found.columns[-3:])).mapInArrow(run, schema)


def remove_hits(found: DataFrame, text_col: str = "text") -> DataFrame:
    """The searched documents with every hit stretch of words cut out of their text.

    A stretch goes from its first word's first letter to its last word's last;
    what stands between words that are not hit is kept as it is.
    """
    own, hits = found.columns[:-3], found.columns[-2]
    place = own.index(text_col)
    rows, _ = neutral(found.select(*map(quoted, own), quoted(hits)))
    inner = rows.columns[:-1]
    out_schema = rows.select(*inner).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in slices(batch.column(place)):
                part = batch.slice(s.first, len(s))
                bits = part.column(len(own)).to_pylist()
                texts = part.column(place).to_pylist()
                if any(bits):
                    at, end, doc = s.words(ALNUM)
                    edge = np.searchsorted(doc, np.arange(len(s) + 1))
                    for k in [k for k, b in enumerate(bits) if b]:
                        lo, hi = edge[k], edge[k + 1]
                        hit = np.unpackbits(np.frombuffer(bits[k], np.uint8), count=hi - lo)
                        step = np.diff(np.concatenate([[0], hit, [0]]).astype(np.int8))
                        blob, pos = [], int(s.starts[k])
                        for a, z in zip(np.flatnonzero(step == 1), np.flatnonzero(step == -1)):
                            blob.append(s.blob[pos : at[lo + a]].tobytes())
                            pos = int(end[lo + z - 1])
                        blob.append(s.blob[pos : s.ends[k]].tobytes())
                        texts[k] = b"".join(blob).decode("utf-8")
                columns = list(part.columns[: len(own)])
                columns[place] = pa.array(texts, columns[place].type)
                yield pa.RecordBatch.from_arrays(columns, names=inner)

    return rows.mapInArrow(run, out_schema).toDF(*own)
