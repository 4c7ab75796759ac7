"""Protein sequence encoders: native expressions, and triads by a kernel over bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The residue letters in the order of the composition vector.
RESIDUES = "ACDEFGHIKLMNPQRSTVWY"
# The seven residue classes of the conjoint triad.
CLASSES = ("AGV", "C", "FILP", "MSTY", "HNQW", "KR", "DE")
_LOWER, _UPPER = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_upper(s: Column) -> Column:
    """Upper case of a-z alone, as SQLite's UPPER has it (Spark's upper folds more)."""
    return F.translate(s, _LOWER, _UPPER)


def composition(s: Column) -> Column:
    """The share of each of the 20 residues among recognised ones; null if there is none."""
    # transform() over a list of one binds what is used more than once.
    cut = lambda u, a: F.octet_length(u) - F.octet_length(F.replace(u, F.lit(a), F.lit("")))
    counts = F.transform(F.array(ascii_upper(s)), lambda u: F.array(*(cut(u, a) for a in RESIDUES)))[0]
    total = lambda c: F.aggregate(c, F.lit(0), lambda acc, x: acc + x)
    paired = F.transform(F.array(counts), lambda c: F.struct(c.alias("c"), total(c).alias("n")))[0]
    return F.transform(F.array(paired), lambda p: F.when(p["n"] > 0, F.transform(p["c"], lambda x: x.cast("double") / p["n"])))[0]


def reduced_alphabet(s: Column) -> Column:
    """Each residue as the digit of its class, anything else as a space.

    Unknown letters are blanked before digits appear, so digits in the text
    can't pass for classes.
    """
    letters = "".join(CLASSES)
    digits = "".join(str(k) * len(g) for k, g in enumerate(CLASSES))
    return F.translate(F.regexp_replace(ascii_upper(s), f"[^{letters}]", " "), letters, digits)


def _byte_classes() -> np.ndarray:
    """The class of each byte, -1 where it is no residue; a-z count as A-Z."""
    out = np.full(256, -1, np.int16)
    for k, group in enumerate(CLASSES):
        for letter in group:
            out[[ord(letter), ord(letter.lower())]] = k
    return out


_CLASS_OF = _byte_classes()


def _triads(column: pa.Array, limit: int = 4 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, row, triad) of runs of rows of about limit bytes: every triad of residues, rows counted from the first."""
    text = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
    data = np.frombuffer(text.buffers()[2] or b"", np.uint8)
    lo = 0
    while lo < len(text):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1)
        code = _CLASS_OF[data[offsets[lo] : offsets[hi]]]
        row = np.repeat(np.arange(hi - lo), np.diff(offsets[lo : hi + 1]))
        a, b, c = code[:-2], code[1:-1], code[2:]
        ok = (a >= 0) & (b >= 0) & (c >= 0) & (row[:-2] == row[2:]) if len(code) > 2 else np.zeros(0, bool)
        yield lo, hi - lo, row[:-2][ok], (a * 49 + b * 7 + c)[ok].astype(np.int64)
        lo = hi


def conjoint_triad(s: Column) -> Column:
    """Counts of the 343 triads of classes, in order; triads with another letter don't count. Null stays null."""

    @F.arrow_udf("array<double>")
    def run(column: pa.Array) -> pa.Array:
        parts = [np.bincount(row * 343 + triad, minlength=n * 343).astype(np.float64) for _, n, row, triad in _triads(column)]
        flat = np.concatenate(parts) if parts else np.zeros(0)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(column) + 1, dtype=np.int32) * 343), pa.array(flat))

    return F.when(s.isNotNull(), run(s))


def normalised(v: Column) -> Column:
    """(v - min) / max, all zeros where the maximum is 0."""
    # bound in a list of one: within a lambda of x they would be found anew for each x
    bound = F.array(F.struct(v.alias("v"), F.array_min(v).alias("low"), F.array_max(v).alias("high")))
    return F.transform(bound, lambda p: F.transform(p["v"], lambda x: F.when(p["high"] == 0, F.lit(0.0)).otherwise((x - p["low"]) / p["high"])))[0]


def triad_counts(df: DataFrame, keys: list[str], sequence: str) -> DataFrame:
    """keys, triad (0 to 342) and n in long form: each sequence is counted where it lies, then equal keys are added up."""
    rows = df.select(*keys, F.col(sequence).cast("string").alias("_s"))
    width = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, _, row, triad in _triads(batch.column(width)):
                kinds, n = np.unique(row * 343 + triad, return_counts=True)
                at = pa.array(first + kinds // 343)
                yield pa.RecordBatch.from_arrays([*(batch.column(k).take(at) for k in range(width)), pa.array((kinds % 343).astype(np.int32)), pa.array(n.astype(np.int64))], names=[*keys, "triad", "n"])

    schema = T.StructType([*rows.schema.fields[:width], T.StructField("triad", T.IntegerType()), T.StructField("n", T.LongType())])
    return rows.mapInArrow(run, schema).groupBy(*keys, "triad").agg(F.sum("n").alias("n"))


def triad_vectors(df: DataFrame, keys: list[str], sequence: str) -> DataFrame:
    """keys and v, the 343 counts of conjoint_triad() where the row lies: no shuffle of triads, no lookup in a map."""
    return df.filter(F.col(sequence).isNotNull()).select(*keys, conjoint_triad(F.col(sequence).cast("string")).alias("v"))


def estate_rows(properties: DataFrame, key: str) -> DataFrame:
    """The E-state of each residue along its descriptors: D_i - sum over j != i of (D_j - D_i) / (j - i)^2.

    The map is linear, so the whole table is done once instead of each residue of each sequence.
    """
    names = [c for c in properties.columns if c != key]

    def state(i: int) -> Column:
        out = F.col(f"`{names[i]}`").cast("double")
        for j in range(len(names)):
            if j != i:
                out = out - (F.col(f"`{names[j]}`") - F.col(f"`{names[i]}`")) / float((j - i) ** 2)
        return out

    return properties.select(F.col(key).alias("aa"), F.array(*(state(i) for i in range(len(names)))).alias("estate"))


def residue_means(df: DataFrame, keys: list[str], sequence: str, table: DataFrame) -> DataFrame:
    """keys, mean (descriptor vector averaged over residues, U counted as C) and length.

    table: aa and estate, of 20 or so rows. A sequence with a residue that the
    table lacks has a null mean, and known says so.
    """
    rows = df.select(*keys, F.translate(F.col(sequence), "U", "C").alias("_s"))
    letters = rows.select(*keys, F.explode(F.split("_s", "")).alias("aa")).filter("aa != ''").groupBy(*keys, "aa").agg(F.count(F.lit(1)).alias("n"))
    joined = letters.join(F.broadcast(table), "aa", "left")
    long = joined.select(*keys, "n", F.col("estate").isNull().alias("miss"), F.posexplode_outer("estate").alias("d", "v"))
    sums = long.groupBy(*keys, "d").agg(F.sum(F.col("n") * F.col("v")).alias("s"), F.sum("n").alias("n"), F.max("miss").alias("miss"))
    out = sums.groupBy(*keys).agg(
        F.max("miss").alias("miss"), F.max("n").alias("n"), F.transform(F.array_sort(F.collect_list(F.struct("d", "s"))), lambda x: x.s).alias("s")
    )
    return out.select(*keys, F.when(~F.col("miss"), F.expr("transform(s, x -> x / n)")).alias("mean"), F.col("n").alias("length"), (~F.col("miss")).alias("known"))


def pair_descriptor(m1: Column, n1: Column, m2: Column, n2: Column, width: int | None = None) -> Column:
    """m12 + m21 - 2 m1 - 2 m2, where m12 = m21 is the mean over both sequences' residues. A known width gives compiled code."""

    def one(a: Column, b: Column) -> Column:
        return 2 * (a * n1 + b * n2) / (n1 + n2) - 2 * a - 2 * b

    return F.zip_with(m1, m2, one) if width is None else F.array(*(one(F.get(m1, F.lit(k)), F.get(m2, F.lit(k))) for k in range(width)))
