"""Language identification with hyperdimensional profiles.

Each letter of any script has a random vector of +1 and -1 of its own, made by
a rule from its code point and a seed. A trigram of letters (word edges count as a letter) binds the
first letter's vector, permuted twice, the second's, permuted once, and the
third's by multiplication. A text bundles the vectors of its trigrams; a
language bundles those of its training texts, in every task, and the tasks'
sums add up. The nearest prototype by cosine gives the language.

The score is that cosine, 0 at least. Nulls and empties: a text that is null,
or without a letter, is `und` with score 0; training skips a null language and
such texts; null ids are carried along, repeated rows are judged each, ties go
to the first language by name. Without any prototype all texts are `und`. An
empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import quoted
from .textkern import Slice, mix, slices

UNKNOWN = "und"
#: Bits of a code point in a trigram's number.
BITS = 21


def letter_vectors(letters: np.ndarray, dims: int, seed: int = 7) -> np.ndarray:
    """The vector of each letter, made from its code point by a rule, as int8; 0 is the edge of a word."""
    n = letters.astype(np.uint64)[:, None] * np.uint64(dims) + np.arange(dims, dtype=np.uint64) + np.uint64(seed << 40)
    return (mix(n) >> np.uint64(63)).astype(np.int8) * 2 - 1


def _letter_table() -> np.ndarray:
    """The lower-cased code point of each letter below 65536, 0 for what is no letter."""
    out = np.zeros(1 << 16, np.int64)
    for cp in range(1 << 16):
        c = chr(cp)
        if c.isalpha():
            out[cp] = ord(c.lower()[0])
    return out


class Profiler:
    """Trigram counts and bundles of whole slices of text."""

    def __init__(self, dims: int) -> None:
        self.dims = dims
        self.table = _letter_table()

    def trigrams(self, s: Slice) -> tuple[np.ndarray, np.ndarray]:
        """Row and trigram number of every trigram; rows ascend."""
        text = s.blob.tobytes().decode("utf-8", "replace")
        cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = self.table[np.minimum(cp, 65535)]
        for k in np.flatnonzero(cp > 65535).tolist():
            letter[k] = ord(chr(cp[k]).lower()[0]) if chr(cp[k]).isalpha() else 0
        # code points to rows: a continuation byte starts none
        heads = (s.blob & 0xC0) != 0x80
        upto = np.cumsum(heads)
        row = np.searchsorted(np.where(s.starts < len(heads), upto[np.minimum(s.starts, len(heads) - 1)] - 1, len(cp)), np.arange(len(cp)), side="right") - 1
        keep = np.ones(len(letter), bool)
        keep[1:] = (letter[1:] > 0) | (letter[:-1] > 0)  # one edge between words
        letter, row = letter[keep], row[keep]
        padded = np.concatenate([[0], letter, [0]])
        a, b, c = padded[:-2], padded[1:-1], padded[2:]
        ok = b > 0
        return row[ok], (a << 2 * BITS | b << BITS | c)[ok]

    def bound(self, numbers: np.ndarray) -> np.ndarray:
        """Each trigram's vector: its letters' ones, permuted twice, once and not at all, multiplied."""
        parts = np.stack([numbers >> 2 * BITS, numbers >> BITS & (1 << BITS) - 1, numbers & (1 << BITS) - 1])
        letters, at = np.unique(parts, return_inverse=True)
        base, at = letter_vectors(letters, self.dims), at.reshape(parts.shape)
        return np.roll(base, 2, axis=1)[at[0]] * np.roll(base, 1, axis=1)[at[1]] * base[at[2]]

    def bundles(self, row: np.ndarray, number: np.ndarray, rows: int) -> np.ndarray:
        """The sum of each row's trigram vectors, as float32 (exact below 2^24)."""
        kinds, at = np.unique(number, return_inverse=True)
        vectors = self.bound(kinds).astype(np.float32)
        out = np.empty((rows, self.dims), np.float32)
        edge = np.searchsorted(row, np.arange(rows + 1))
        step = max(1, (4 << 20) // max(1, len(kinds)))
        for lo in range(0, rows, step):
            hi = min(rows, lo + step)
            own = slice(edge[lo], edge[hi])
            counts = np.bincount((row[own] - lo) * len(kinds) + at[own], minlength=(hi - lo) * len(kinds))
            out[lo:hi] = counts.reshape(hi - lo, len(kinds)).astype(np.float32) @ vectors
        return out


def prototypes(train: DataFrame, dims: int = 512, text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """The languages in order of name, and their bundles scaled to length 1.

    Every labelled text takes part. One row for each language and dimension
    comes to the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiler = Profiler(dims)
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            names = np.array(batch.column(1).to_pylist(), object)
            for s in slices(batch.column(0)):
                row, number = profiler.trigrams(s)
                own = names[s.first : s.first + len(s)][row]
                for name in set(own.tolist()):
                    kinds, n = np.unique(number[own == name], return_counts=True)
                    sums[name] = sums.get(name, 0) + n.astype(np.float64) @ profiler.bound(kinds).astype(np.float64)
        for name, v in sums.items():
            yield pa.record_batch([pa.array([name] * dims), pa.array(np.arange(dims)), pa.array(np.rint(v).astype(np.int64))], names=["lang", "d", "v"])

    rows = train.select(F.col(quoted(text_col)).alias("text"), F.col(quoted(lang_col)).alias("lang")).filter("text IS NOT NULL AND lang IS NOT NULL")
    found = rows.mapInArrow(run, "lang string, d long, v long").groupBy("lang", "d").agg(F.sum("v").alias("v")).collect()
    names = sorted({r.lang for r in found})
    out = np.zeros((len(names), dims))
    for r in found:
        out[names.index(r.lang), r.d] = r.v
    length = np.linalg.norm(out, axis=1, keepdims=True)
    return names, (out / np.where(length == 0, 1, length)).astype(np.float32)


def predict(docs: DataFrame, names: list[str], profiles: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred and score of each row of docs."""
    dims = profiles.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiler = Profiler(dims)
        known = np.array([*names, UNKNOWN], object)
        for batch in batches:
            for s in slices(batch.column(1)):
                row, number = profiler.trigrams(s)
                v = profiler.bundles(row, number, len(s))
                best, score = np.full(len(s), len(names)), np.zeros(len(s))
                has = np.bincount(row, minlength=len(s)) > 0
                if names and has.any():
                    own = v[has]
                    length = np.linalg.norm(own, axis=1, keepdims=True)
                    cos = own @ profiles.T / np.where(length == 0, 1, length)
                    best[has] = cos.argmax(1)
                    score[has] = np.clip(cos.max(1), 0, 1)
                yield pa.record_batch([batch.column(0).slice(s.first, len(s)), pa.array(known[best].tolist(), pa.string()), pa.array(score.astype(np.float64))], names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col(quoted(id_col)).cast("long").alias("doc_id"), F.col(quoted(text_col)).alias("text")).mapInArrow(run, "doc_id long, lang_pred string, score double")
