"""Embedding whitening: principal components by spectrum slicing, in exact integer moments.

Entries become integers (floor(scale * entry)), and each distinct vector takes
part once. Vectors are deduplicated by an exchange of their packed bytes, so a
vector that a third of all rows hold is one row after its own task. Two passes
over the distinct vectors give their number and sums, and then the sums of products of
entries less the rounded mean: small integers, added up exactly, so the
covariance is right to rounding and the same for any partitions.

The covariance, of the embedding's dimensions squared, is all that comes to
the driver. Its leading eigenvalues are isolated by slicing the spectrum: the
inertia of LDL^T of the covariance less a shift counts eigenvalues above the
shift. In an interval that holds one eigenvalue, Rayleigh quotient
iteration converges cubically, and counts around the result certify its number.
Equal eigenvalues share an interval, and their vectors are made orthogonal.

Nulls and empties: rows whose vector is null, or has a null, NaN or infinite
entry, are dropped. Vectors of several lengths can't share a covariance: the
length that most distinct vectors have is used (of ties the longer one), others
are dropped. Entries beyond 64 bits when scaled are clipped to them. Null ids
are carried along, repeated ids and vectors get a row each. Fewer dimensions
than components give as many components. Where an eigenvalue isn't above
rounding, whitened is null; explained is null where all vectors are equal. A
deviation beyond 64 bits is null. No row left gives no rows. Other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .runtime import Scratch, quoted

WIDTHS = {1: np.int8, 2: np.int16, 4: np.int32, 8: np.int64}
#: Rows of vectors that are held as a matrix at once.
ROWS = 4096


def _matrices(column: pa.Array, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and integer vectors (a matrix) of the usable rows of a list column, for each length."""
    column = column.cast(pa.list_(pa.float64()))
    start = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)
    size = np.diff(start)
    good = np.isfinite(values)  # nulls have become NaN
    faults = np.concatenate([[0], np.cumsum(~good)])
    usable = (faults[start[1:]] == faults[start[:-1]]) & np.asarray(column.is_valid()) & (size > 0)
    for length in np.unique(size[usable]).tolist():
        own = np.flatnonzero(usable & (size == length))
        for lo in range(0, len(own), ROWS):
            some = own[lo : lo + ROWS]
            x = np.floor(scale * values[start[some][:, None] + np.arange(length)])
            top = np.clip(x, -(2.0**63), np.nextafter(2.0**63, 0))
            yield some, top.astype(np.int64)


def _packed(x: np.ndarray) -> list[bytes]:
    """Each row's entries in the least width that holds them."""
    low, high = x.min(1), x.max(1)
    width = np.full(len(x), 8)
    for w in (4, 2, 1):
        width[(low >= -(1 << 8 * w - 1)) & (high < 1 << 8 * w - 1)] = w
    out = [b""] * len(x)
    for w in np.unique(width).tolist():
        own = np.flatnonzero(width == w)
        body = x[own].astype(WIDTHS[w]).tobytes()
        step = w * x.shape[1]
        for k, i in enumerate(own.tolist()):
            out[i] = bytes([w]) + body[k * step : (k + 1) * step]
    return out


def _unpacked(column: pa.Array, size: int) -> np.ndarray:
    """The vectors of a column of packed ones, of one length."""
    out = np.empty((len(column), size), np.int64)
    for k, blob in enumerate(column):
        raw = blob.as_py()
        out[k] = np.frombuffer(raw, WIDTHS[raw[0]], offset=1)
    return out


def distinct_vectors(vectors: DataFrame, scale: int) -> DataFrame:
    """dims and x (packed) of each distinct integer vector of rows of (embedding)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, x in _matrices(batch.column(0), scale):
                yield pa.record_batch([pa.array(np.full(len(x), x.shape[1], np.int32)), pa.array(_packed(x), pa.binary())], names=["dims", "x"])

    return vectors.mapInArrow(run, "dims int, x binary").distinct()


def _products(z: np.ndarray) -> np.ndarray:
    """z^T z exactly: in doubles while no sum can pass 2^53, else in Python's integers."""
    most = max(1, int(np.abs(z.astype(np.float64)).max()))
    if most * most * len(z) < 1 << 53:
        z = z.astype(np.float64)
        return (z.T @ z).astype(np.int64).astype(object)
    z = z.astype(object)
    return z.T @ z


def _total(x: np.ndarray) -> np.ndarray:
    """The columns' sums, exactly."""
    safe = float(np.abs(x.astype(np.float64)).max()) * len(x) < 1 << 62
    return (x.sum(0) if safe else x.astype(object).sum(0)).astype(object)


HALVES = "high decimal(38,0), low decimal(38,0)"


def _halves(values: np.ndarray) -> list[pa.Array]:
    """Integers of any size as two columns, which tasks' sums can't overflow."""
    return [pa.array([Decimal(h) for h in half], pa.decimal128(38)) for half in ([v >> 64 for v in values], [v & (1 << 64) - 1 for v in values])]


def moments(fit: DataFrame, dims: int, centre: np.ndarray) -> tuple[list[int], list[list[int]]]:
    """Sums of z and of z z^T over fit's vectors, z = x - centre, as exact integers.

    A task sends dims + 1 rows of dims sums; dims rows come to the driver.
    """
    middle = centre.astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, n = np.full((dims + 1, dims), 0, object), 0
        for batch in batches:
            for lo in range(0, len(batch), ROWS):
                z = _unpacked(batch.column(0).slice(lo, ROWS), dims) - middle
                sums[0] += _total(z)
                sums[1:] += _products(z)
                n += len(z)
        if n:
            for i in range(dims + 1):
                yield pa.record_batch([pa.array([i] * dims, pa.int32()), pa.array(range(dims), pa.int32()), *_halves(sums[i])], names=["i", "j", "high", "low"])

    rows = fit.select("x").mapInArrow(run, f"i int, j int, {HALVES}").groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low"))
    out = [[0] * dims for _ in range(dims + 1)]
    for r in rows.collect():  # (dims + 1) * dims numbers
        out[r.i][r.j] = (int(r.high) << 64) + int(r.low)
    return out[0], out[1:]


def inertia(a: np.ndarray, shift: float) -> int:
    """How many eigenvalues of the symmetric a lie above shift: the positive ones of D in LDL^T of a - shift.

    Pivots of one or two rows, chosen by the Bunch-Kaufman rule.
    """
    m = a - shift * np.eye(len(a))
    n, k, above, turn = len(a), 0, 0, (1 + np.sqrt(17)) / 8
    while k < n:
        col = np.abs(m[k + 1 :, k])
        r = k + 1 + int(col.argmax()) if len(col) else k
        lam, pick, two = col.max() if len(col) else 0.0, k, False
        if max(abs(m[k, k]), lam) > 0 and abs(m[k, k]) < turn * lam:
            rest = np.abs(m[r, k:])
            rest[r - k] = 0
            sigma = rest.max()
            if abs(m[k, k]) * sigma < turn * lam * lam:
                if abs(m[r, r]) >= turn * sigma:
                    pick = r
                else:
                    pick, two = r, True
        at = k + 1 if two else k
        if pick != at:
            m[[at, pick]] = m[[pick, at]]
            m[:, [at, pick]] = m[:, [pick, at]]
        if two:
            block, left = m[k : k + 2, k : k + 2].copy(), m[k + 2 :, k : k + 2].copy()
            m[k + 2 :, k + 2 :] -= left @ np.linalg.solve(block, left.T)
            above += 1  # a two-row pivot of this rule has one eigenvalue of each sign
            k += 2
        else:
            if m[k, k]:
                left = m[k + 1 :, k].copy()
                m[k + 1 :, k + 1 :] -= np.outer(left, left / m[k, k])
                above += m[k, k] > 0
            k += 1
    return int(above)


def leading(a: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The count largest eigenvalues of the symmetric a, falling, and their unit eigenvectors as rows."""
    size = len(a)
    scale = np.abs(a).sum(1).max()
    values, vectors = [], np.zeros((0, size))
    if not scale > 0:
        return np.zeros(min(count, size)), np.eye(size)[:count]
    low, high, close = -scale * (1 + 1e-12), scale * (1 + 1e-12), 8 * size * np.finfo(float).eps * scale
    known = {low: size, high: 0}  # eigenvalues above each shift that was tried

    def above(shift: float) -> int:
        if shift not in known:
            known[shift] = inertia(a, shift)
        return known[shift]

    for k in range(1, min(count, size) + 1):
        # the k-th lies in (lo, hi]: at least k are above lo, fewer than k above hi
        lo, hi = max(s for s, n in known.items() if n >= k), min(s for s, n in known.items() if n < k)
        while True:
            alone = above(lo) - above(hi) == 1
            if not alone and hi - lo > close:
                mid = (lo + hi) / 2
                lo, hi = (mid, hi) if above(mid) >= k else (lo, mid)
                continue
            found = _refined(a, (lo + hi) / 2, vectors, scale)
            if found and lo - close <= found[0] <= hi + close:
                value, v = found
                if above(value - close) >= k > above(value + close):  # certified
                    break
            if hi - lo <= close:
                raise ArithmeticError(f"component {k} could not be certified")
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if above(mid) >= k else (lo, mid)
        values.append(value)
        vectors = np.vstack([vectors, v])
    return np.array(values), vectors


def _refined(a: np.ndarray, shift: float, found: np.ndarray, scale: float) -> tuple[float, np.ndarray] | None:
    """Rayleigh quotient iteration from an inverse iteration at shift, kept orthogonal to the rows of found."""
    size, tiny = len(a), np.finfo(float).eps * scale
    v = 1 + np.arange(size) % 7 / 7.0  # any fixed start
    rho, good = shift, 0
    for step in range(60):
        v = v - found.T @ (found @ v)
        v /= np.linalg.norm(v)
        if step >= 3:
            rho = v @ a @ v
            good += np.linalg.norm(a @ v - rho * v) <= 4 * size**0.5 * tiny
            if good == 2:  # one more step than needed: convergence is cubic
                return float(rho), v
        try:
            w = np.linalg.solve(a - rho * np.eye(size), v)
        except np.linalg.LinAlgError:  # rho is an eigenvalue to the last bit
            w = np.linalg.solve(a - (rho + 4 * tiny) * np.eye(size), v)
        w = w - found.T @ (found @ w)
        length = np.linalg.norm(w)
        if not np.isfinite(length) or not length:
            return None
        v = w / length
    return None


def whiten(df: DataFrame, components: int = 4, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained and identity_error for each usable row and component."""
    spark = df.sparkSession
    scratch = Scratch(spark)
    rows = df.select(F.col(quoted(id_col)).alias("vec_id"), F.col(quoted(vector_col)).alias("embedding"))
    fit = scratch.table(distinct_vectors(rows.select("embedding"), scale), "fit")
    lengths = fit.groupBy("dims").count().agg(F.max(F.struct("count", "dims")).alias("m")).head().m
    schema = f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if lengths is None:
        return spark.createDataFrame([], schema)
    n, dims = int(lengths["count"]), int(lengths["dims"])
    fit = fit.filter(F.col("dims") == dims)
    sums = _sums(fit, dims)
    centre = np.array([min(max(round(Fraction(s, n)), -(1 << 62)), 1 << 62) for s in sums], np.int64)
    first, second = moments(fit, dims, centre)
    covariance = np.array([[float(Fraction(n * second[i][j] - first[i] * first[j], n * n)) for j in range(dims)] for i in range(dims)])
    values, vectors = leading(covariance, components)
    trace = float(sum(Fraction(n * second[i][i] - first[i] ** 2, n * n) for i in range(dims)))
    real = values > 64 * dims * np.finfo(float).eps * max(trace, 1e-300)
    project = np.where(real[:, None], vectors / np.sqrt(np.where(real, values, 1))[:, None], np.nan)
    offset = [s - n * int(c) for s, c in zip(sums, centre)]  # n * x - S = n * (x - centre) - offset
    small = all(abs(v) < 1 << 62 for v in sums)

    def whitened(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """n * x - S, exactly, and x - S / n projected and scaled."""
        if small and n * max(1, float(np.abs(x.astype(np.float64)).max())) < 1 << 61:
            far = n * x - np.array(sums, np.int64)
        else:
            far = n * x.astype(object) - np.array(sums, object)
        z = (x - centre).astype(np.float64) - np.array([float(Fraction(o, n)) for o in offset])
        return far, z @ project.T

    error = _identity_error(fit, dims, n, whitened, int(real.sum()), real)
    explained = values / trace if trace > 0 else np.full(len(values), np.nan)
    numbers = np.arange(1, len(values) + 1, dtype=np.int32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(numbers)
        for batch in batches:
            for at, x in _matrices(batch.column(1), scale):
                if x.shape[1] != dims:
                    continue
                far, w = whitened(x)
                deviation = _squares(far)
                yield pa.record_batch(
                    [
                        batch.column(0).take(pa.array(np.repeat(at, k))), pa.array(np.tile(numbers, len(at))), pa.array(np.full(len(at) * k, n)),
                        pa.array([d for d in deviation for _ in range(k)], pa.int64()), pa.array(w.ravel(), from_pandas=True), pa.array(np.tile(explained, len(at)), from_pandas=True), pa.array(np.full(len(at) * k, error), from_pandas=True),
                    ],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.mapInArrow(run, schema)


def _squares(far: np.ndarray) -> list[int | None]:
    """The sum of squares of each row, exactly; None beyond 64 bits."""
    top = float(np.abs(far.astype(np.float64)).max())
    if far.dtype != object and top * top * far.shape[1] < 2.0**62:
        return (far * far).sum(1).tolist()
    wide = far.astype(object)
    return [d if d < 1 << 63 else None for d in (int(v) for v in (wide * wide).sum(1))]


def _sums(fit: DataFrame, dims: int) -> list[int]:
    """The sum of each entry over fit's vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.full(dims, 0, object)
        for batch in batches:
            for lo in range(0, len(batch), ROWS):
                sums += _total(_unpacked(batch.column(0).slice(lo, ROWS), dims))
        yield pa.record_batch([pa.array(range(dims), pa.int32()), *_halves(sums)], names=["i", "high", "low"])

    found = fit.select("x").mapInArrow(run, f"i int, {HALVES}").groupBy("i").agg(F.sum("high").alias("high"), F.sum("low").alias("low"))
    out = [0] * dims
    for r in found.collect():  # dims numbers
        out[r.i] = (int(r.high) << 64) + int(r.low)
    return out


def _identity_error(fit: DataFrame, dims: int, n: int, whitened, count: int, real: np.ndarray) -> float:
    """The largest entry of the whitened fit list's covariance less the identity, measured on its vectors."""
    if not count:
        return float("nan")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((count + 1, count))
        for batch in batches:
            for lo in range(0, len(batch), ROWS):
                w = whitened(_unpacked(batch.column(0).slice(lo, ROWS), dims))[1][:, real]
                sums[0] += w.sum(0)  # w is centred; what its mean leaves is taken off
                sums[1:] += w.T @ w
        i, j = np.indices(sums.shape)
        yield pa.record_batch([pa.array(i.ravel().astype(np.int32)), pa.array(j.ravel().astype(np.int32)), pa.array(sums.ravel())], names=["i", "j", "v"])

    sums = np.zeros((count + 1, count))
    for r in fit.select("x").mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        sums[r.i, r.j] = r.v
    return float(np.abs(sums[1:] / n - np.outer(sums[0], sums[0]) / n**2 - np.eye(count)).max())
