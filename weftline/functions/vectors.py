"""Vectors as arrays: decoding, slicing, means, concatenation, row filters, random controls."""

from __future__ import annotations

import io
import pickle

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class _ArraysOnly(pickle.Unpickler):
    """Unpickles NumPy arrays and nothing else, so a blob can't run code."""

    ALLOWED = {
        ("numpy.core.multiarray", "_reconstruct"), ("numpy._core.multiarray", "_reconstruct"),
        ("numpy", "ndarray"), ("numpy", "dtype"), ("_codecs", "encode"),
        ("numpy.core.numeric", "_frombuffer"), ("numpy._core.numeric", "_frombuffer"),
    }

    def find_class(self, module: str, name: str):
        if (module, name) not in self.ALLOWED:
            raise pickle.UnpicklingError(f"{module}.{name} isn't allowed in an array blob")
        return super().find_class(module, name)


def decode_array(blob: bytes) -> np.ndarray:
    out = _ArraysOnly(io.BytesIO(blob)).load()
    if not isinstance(out, np.ndarray) or out.dtype.hasobject:
        raise pickle.UnpicklingError("the blob isn't a plain array")
    return out


def decode_vector(blob: str | Column) -> Column:
    """A pickled one-dimensional array as array<float>; null stays null."""

    def run(blobs: pd.Series) -> pd.Series:
        return blobs.map(lambda b: None if b is None else decode_array(b).astype(np.float32).ravel())

    return F.pandas_udf(run, "array<float>")(blob)


def decode_matrix(blob: str | Column) -> Column:
    """A pickled two-dimensional array as rows."""

    def run(blobs: pd.Series) -> pd.Series:
        return blobs.map(lambda b: None if b is None else list(decode_array(b).astype(np.float32)))

    return F.pandas_udf(run, "array<array<float>>")(blob)


def residue_slice(matrix: Column, start: Column, end: Column) -> Column:
    """Rows [start, end), counted from 0."""
    return F.when(end > start, F.slice(matrix, start + 1, end - start)).otherwise(F.array().cast("array<array<float>>"))


def slice_mean(matrix: Column, start: Column, end: Column) -> Column:
    """The mean vector of rows [start, end); null where there are none. A decoded matrix must be a column already."""
    part = residue_slice(matrix, start, end)
    n = F.size(part)
    width = F.size(F.element_at(part, 1))
    sums = F.aggregate(part, F.array_repeat(F.lit(0.0), width), lambda acc, row: F.zip_with(acc, row, lambda a, b: a + b))
    return F.when(n > 0, F.transform(sums, lambda x: x / n))


def all_finite(v: Column) -> Column:
    """Whether no value of v is NaN or null."""
    return ~F.exists(v, lambda x: F.isnan(x) | x.isNull())


def drop_nan_rows(df: DataFrame, vec: str) -> DataFrame:
    return df.filter(F.col(vec).isNotNull() & all_finite(F.col(vec)))


def concat_vectors(*vectors: Column) -> Column:
    return F.concat(*vectors)


def sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def hash_uniform(seed: int, *keys: Column) -> Column:
    """A number in (0, 1) that depends on seed and keys alone, not on partitions."""
    return (F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit((1 << 53) - 1)) + 1).cast("double") / float(1 << 53)


def hash_normal(seed: int, *keys: Column) -> Column:
    """A standard normal number by keys (Box-Muller)."""
    u, v = hash_uniform(seed, *keys), hash_uniform(seed + 1, *keys)
    return F.sqrt(-2 * F.log(u)) * F.cos(2 * np.pi * v)


def dummy_vector(seed: int, *keys: Column, width: int = 512) -> Column:
    """The control feature: normal noise by key."""
    return F.transform(F.sequence(F.lit(1), F.lit(width)), lambda i: hash_normal(seed, *keys, i).cast("float"))
