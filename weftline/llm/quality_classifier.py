"""Quality classifier: random Fourier features of document statistics, ridge regression, isotonic calibration.

1. Each text becomes a short row of statistics of its bytes, words and lines,
   taken over the whole text and written once.
2. Random Fourier features, cosines of random projections of the standardised
   statistics, approximate a Gaussian kernel, for a few bandwidths at once.
3. Tasks add up the normal equations of each bandwidth and fold over the
   labelled rows; strips of the tasks' sums are added in tasks of their own, and
   the totals come to the driver: their size depends on the number of features alone.
   What a fold leaves out is a difference of totals, so bandwidth and
   ridge are chosen by the squared error on rows that a fit hasn't seen, without
   another pass.
4. Each labelled row is scored by the fit of the other folds. Counts of labels
   in fine score bins give, by pooling adjacent violators, a rising
   function from score to the share of label 1.

The fold of a row hashes its statistics, so copies share a fold. All labelled
rows take part. Labels of one document are averaged.

Nulls and empties: a null text counts as empty, which has statistics and so a
score; labels with a null id or a null quality are left out; null ids are
carried along; repeated rows are scored each, and learned from each. Equal
scores have equal calibrated scores. Without a labelled row all scores are 0.5. An
empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .runtime import Scratch, quoted
from .textkern import NON_SPACE, Slice, combine, slices

FOLDS = 5
BANDWIDTHS = (0.5, 1.0, 2.0)
RIDGES = tuple(10.0**k for k in range(-7, 0))
#: Rows of a strip of a matrix, and standard deviations at which a statistic is cut off.
STRIP, FAR = 32, 6.0

NAMES = [
    "log_words", "log_bytes", "word_length", "word_length_spread", "upper_share", "digit_share", "symbol_share", "stop_share", "mark_share", "space_share", "wide_share", "lines_per_word",
    "distinct_share", "repeat_share", "top_word_share", "capital_share", "entropy", "repeat_line_share", "end_mark_share", "short_share",
]
_CLASSES = ["ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "#*$%&|<>", ".,;:'\"-()", "!?{}[]\\^~=_+@/"]


def _byte_classes() -> np.ndarray:
    """256 by classes: upper-case letters, digits, symbols, stops, marks, white space, bytes beyond ASCII."""
    out = np.zeros((256, len(_CLASSES) + 2))
    for k, letters in enumerate(_CLASSES):
        out[list(letters.encode()), k] = 1
    out[[0x20, *range(0x09, 0x0E)], -2] = 1
    out[0x80:, -1] = 1
    return out


_BYTE_CLASSES = _byte_classes()


def _repeated(row: np.ndarray, key: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each row, how many distinct keys, how many keys that come twice or more, and the largest count of one."""
    order = np.lexsort((key, row))
    r, k = row[order], key[order]
    new = np.ones(len(r), bool)
    new[1:] = (r[1:] != r[:-1]) | (k[1:] != k[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(r)))
    most = np.zeros(rows, np.int64)
    np.maximum.at(most, r[first], count)
    return np.bincount(r[first], minlength=rows), np.bincount(r[first], np.where(count > 1, count, 0), rows), most


def statistics(s: Slice) -> np.ndarray:
    """Rows by NAMES of a slice of texts."""
    rows, size = len(s), (s.ends - s.starts).astype(np.float64)
    of_byte = np.repeat(np.arange(rows), (s.ends - s.starts + 1))
    seen = np.bincount(of_byte * 256 + s.blob, minlength=rows * 256).reshape(rows, 256).astype(np.float64)
    seen[:, 10] -= 1  # the newline that ends each text
    share = seen / np.maximum(size, 1)[:, None]
    classes = share @ _BYTE_CLASSES
    entropy = -(share * np.log2(np.where(share > 0, share, 1))).sum(1)
    at, end, row = s.words(NON_SPACE)
    n = np.bincount(row, minlength=rows).astype(np.float64)
    some = np.maximum(n, 1)
    length = (end - at).astype(np.float64)
    mean = np.bincount(row, length, rows) / some
    spread = np.sqrt(np.maximum(np.bincount(row, length**2, rows) / some - mean**2, 0))
    h = s.hashes(at, end)
    distinct, _, most = _repeated(row, h, rows)
    whole = row[2:] == row[:-2]
    _, again, _ = _repeated(row[2:][whole], combine(h[:-2][whole], h[1:-1][whole], h[2:][whole]), rows)
    first, last = s.blob[at], s.blob[np.maximum(end - 1, 0)]
    capital = (first >= 0x41) & (first <= 0x5A)
    marked = (_BYTE_CLASSES[:, 2] + _BYTE_CLASSES[:, 4] > 0)[last]
    # lines with a word are known by the sum of their words' places and hashes
    line = np.cumsum(s.blob == 10)[at] if len(at) else at
    edge = np.flatnonzero(np.diff(line, prepend=-1))
    place = np.arange(len(at)) - np.repeat(edge, np.diff(np.append(edge, len(at))))
    line_key = np.add.reduceat(combine(h, place.astype(np.uint64)), edge) if len(edge) else h
    line_row = row[edge]
    lines = np.bincount(line_row, minlength=rows)
    kinds, _, _ = _repeated(line_row, line_key, rows)
    columns = [
        np.log1p(n), np.log1p(size), np.log1p(mean), np.log1p(spread), *classes.T[:7], lines / some,
        distinct / some, again / some, most / some, np.bincount(row, capital, rows) / some, entropy, 1 - kinds / np.maximum(lines, 1), np.bincount(row, marked, rows) / some, np.bincount(row, length <= 1, rows) / some,
    ]
    return np.stack(columns, axis=1)


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and f, the statistics of each row of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in slices(batch.column(1)):
                f = statistics(s)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(s) + 1, dtype=np.int32) * f.shape[1]), pa.array(f.ravel()))
                yield pa.record_batch([batch.column(0).slice(s.first, len(s)), lists], names=["doc_id", "f"])

    rows = docs.select(F.col(quoted(id_col)).alias("doc_id"), F.col(quoted(text_col)).alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, f array<double>")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


@dataclass
class Map:
    """Random Fourier features of one bandwidth, and the constant 1 as the last."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray

    def __call__(self, f: np.ndarray) -> np.ndarray:
        z = np.clip((f - self.mean) / self.scale, -FAR, FAR)
        out = np.ones((len(f), len(self.phases) + 1))
        out[:, :-1] = np.cos(z @ self.directions + self.phases) * np.sqrt(2 / len(self.phases))
        return out


def fourier_maps(mean: np.ndarray, scale: np.ndarray, features: int, seed: int) -> list[Map]:
    """A map for each bandwidth, which counts in roots of the number of statistics."""
    draw = np.random.default_rng(seed)
    directions, phases = draw.normal(size=(len(mean), features)), draw.uniform(0, 2 * np.pi, features)
    return [Map(mean, scale, directions / (b * np.sqrt(len(mean))), phases) for b in BANDWIDTHS]


@dataclass
class Model:
    """A ridge fit on one feature map, and the calibrating steps: score becomes the share of label 1."""

    features: Map | None
    weights: np.ndarray
    at: np.ndarray
    share: np.ndarray

    def __call__(self, f: np.ndarray) -> np.ndarray:
        if self.features is None:
            return np.full(len(f), 0.5)
        return np.clip(np.interp(self.features(f) @ self.weights, self.at, self.share), 0, 1)


def normal_equations(train: DataFrame, maps: list[Map]) -> np.ndarray:
    """maps by folds of [X y]^T [X y], from rows (f, y, fold); totals of tasks are added strip by strip."""
    width = len(maps[0].phases) + 2
    strips = -(-width // STRIP)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, used = np.zeros((len(maps), FOLDS, width, width)), np.zeros(FOLDS, bool)
        for batch in batches:
            if not len(batch):
                continue
            f, y, fold = _matrix(batch.column(0)), batch.column(1).to_numpy(), batch.column(2).to_numpy()
            for m, one in enumerate(maps):
                x = np.column_stack([one(f), y])
                for k in np.unique(fold).tolist():
                    used[k] = True
                    own = x[fold == k]
                    sums[m, k] += own.T @ own
        for m in range(len(maps)):
            for k in np.flatnonzero(used).tolist():
                part = [(m * FOLDS + k) * strips + i for i in range(strips)]
                yield pa.record_batch([pa.array(part, pa.int32()), pa.array([sums[m, k, i * STRIP : (i + 1) * STRIP].tobytes() for i in range(strips)], pa.binary())], names=["part", "body"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                sums[part] = sums.get(part, 0) + np.frombuffer(body.as_buffer(), np.float64)
        if sums:
            yield pa.record_batch([pa.array(list(sums), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], names=["part", "body"])

    shape = "part int, body binary"
    out = np.zeros((len(maps) * FOLDS, width, width))
    for r in train.select("f", "y", "fold").mapInArrow(partial, shape).repartition("part").mapInArrow(added, shape).collect():
        k, i = divmod(r.part, strips)
        out[k, i * STRIP : (i + 1) * STRIP] = np.frombuffer(r.body, np.float64).reshape(-1, width)
    return out.reshape(len(maps), FOLDS, width, width)


def ridge_fit(total: np.ndarray, ridge: float) -> np.ndarray:
    """The weights of [X y]^T [X y]; the constant isn't shrunk."""
    gram, n = total[:-1, :-1], total[-2, -2]
    shrink = np.full(len(gram), max(ridge * n, 1e-9))
    shrink[-1] = 1e-9
    return np.linalg.solve(gram + np.diag(shrink), total[:-1, -1])


def chosen(sums: np.ndarray) -> tuple[int, float]:
    """The map and ridge of the least squared error on the folds left out; of equals the smoother."""
    best = (np.inf, 0, RIDGES[-1])
    for m in range(len(sums)):
        whole = sums[m].sum(0)
        for ridge in reversed(RIDGES):
            error = 0.0
            for own in sums[m]:
                if (whole - own)[-2, -2] > 0.5:  # rows that the others have
                    w = np.append(ridge_fit(whole - own, ridge), -1.0)
                    error += w @ own @ w
            if error < best[0] * (1 - 1e-9):
                best = (error, m, ridge)
    return best[1:]


def rising(score: np.ndarray, share: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pooled adjacent violators: places and rising values of bins in order of score."""
    blocks: list[list[float]] = []
    for s, v, w in zip(score.tolist(), share.tolist(), weight.tolist()):
        blocks.append([s * w, v * w, w, s, s])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            top = blocks.pop()
            low = blocks[-1]
            blocks[-1] = [low[0] + top[0], low[1] + top[1], low[2] + top[2], low[3], top[4]]
    ends = [(x, b[1] / b[2]) for b in blocks for x in ((b[3], b[4]) if b[4] > b[3] else (b[3],))]
    return np.array([x for x, _ in ends]), np.array([v for _, v in ends])


def fit(train: DataFrame, features: int = 256, bins: int = 4096, seed: int = 13) -> Model:
    """The classifier of rows (f, y): y from 0 to 1. bins: of scores from -1 to 2, the grain of the calibration."""
    rows = train.withColumn("fold", F.pmod(F.xxhash64("f"), F.lit(FOLDS)).cast("int"))

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((3, len(NAMES)))
        for batch in batches:
            if len(batch):
                f = _matrix(batch.column(0))
                sums += np.stack([np.full(len(NAMES), len(f)), f.sum(0), (f**2).sum(0)])
        yield pa.record_batch([pa.array(np.arange(len(NAMES), dtype=np.int32)), *map(pa.array, sums)], names=["k", "n", "s", "q"])

    found = rows.select("f").mapInArrow(moments, "k int, n double, s double, q double").groupBy("k").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q")).orderBy("k").collect()
    if not found or not found[0].n:
        return Model(None, np.zeros(0), np.zeros(0), np.zeros(0))
    n, s, q = (np.array([r[c] for r in found]) for c in ("n", "s", "q"))
    spread = np.sqrt(np.maximum(q / n - (s / n) ** 2, 0))
    maps = fourier_maps(s / n, np.where(spread > 1e-9, spread, 1.0), features, seed)
    sums = normal_equations(rows, maps)
    m, ridge = chosen(sums)
    one, whole = maps[m], sums[m].sum(0)
    seen = [(whole - own) if (whole - own)[-2, -2] > 0.5 else whole for own in sums[m]]
    others = np.stack([ridge_fit(part, ridge) for part in seen])

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((3, bins))
        for batch in batches:
            if len(batch):
                f, y, fold = _matrix(batch.column(0)), batch.column(1).to_numpy(), batch.column(2).to_numpy()
                score = (one(f) * others[fold]).sum(1)
                at = np.clip((score + 1) / 3 * bins, 0, bins - 1).astype(np.int64)
                sums += np.stack([np.bincount(at, w, bins) for w in (None, np.clip(score, -1, 2), y)])
        at = np.flatnonzero(sums[0])
        yield pa.record_batch([pa.array(at.astype(np.int32)), *(pa.array(v[at]) for v in sums)], names=["b", "n", "s", "y"])

    held = rows.select("f", "y", "fold").mapInArrow(binned, "b int, n double, s double, y double").groupBy("b").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("y").alias("y")).orderBy("b").collect()  # bins rows at most
    n, s, y = (np.array([r[c] for r in held]) for c in ("n", "s", "y"))
    at, share = rising(s / n, y / n, n)
    return Model(one, ridge_fit(whole, ridge), at, share)


def predicted(rows: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of rows (doc_id, f)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = model(_matrix(batch.column(1))) if len(batch) else np.zeros(0)
            yield pa.record_batch([batch.column(0), pa.array(score)], names=["doc_id", "score"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")


def classify(docs: DataFrame, labels: DataFrame, learn: Column | None = None, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", features: int = 256) -> tuple[DataFrame, Model]:
    """doc_id and score of each row of docs, and the model. labels: id_col and label_col (0 or 1).

    learn: a condition on doc_id; labels of other documents aren't read.
    """
    scratch = Scratch(docs.sparkSession)
    table = scratch.table(measured(docs, id_col, text_col), "measured")
    given = labels.select(F.col(quoted(id_col)).alias("doc_id"), F.col(quoted(label_col)).cast("double").alias("y"))
    if learn is not None:
        given = given.filter(learn)
    target = given.filter("doc_id IS NOT NULL AND y IS NOT NULL AND y BETWEEN 0 AND 1").groupBy("doc_id").agg(F.avg("y").alias("y"))
    train = scratch.table(table.join(target, "doc_id").select("f", "y"), "train")
    model = fit(train, features)
    scratch.drop("train")
    return predicted(table, model), model
