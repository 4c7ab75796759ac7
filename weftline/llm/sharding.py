"""Sharding by histogram sort: near equal bytes for each shard, one exchange.

Rows are ordered by a 63-bit key, the text's hash above a tie hash, so equal
texts lie side by side. Rounds count the exact bytes below candidate boundaries
in every partition and narrow each splitter's bracket until the bytes below it
are within the tolerance. Splitters stay between groups of equal texts; only a
group larger than the tolerance is cut, by its tie hash. Rows then move once,
to cells that nest in shards, whole, and are numbered inside their cell.

Nulls and empties: a null size counts as 0 and a null text as an empty one.
Repeated rows are kept, each with a slot of its own. An empty table gives an
empty result. All columns of the input are kept; the names added (shard, slot)
replace columns of that name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .runtime import Scratch, exact_keys, quoted

TIE_BITS = 23
TOP = 1 << 63


def sort_key(text: Column, row_id: Column) -> Column:
    """40 bits of the text's hash, then 23 bits that tell rows of one text apart."""
    high = F.shiftrightunsigned(F.xxhash64(F.coalesce(text, F.lit(""))), 24)
    low = F.shiftrightunsigned(F.xxhash64(row_id, F.monotonically_increasing_id()), 64 - TIE_BITS)
    return F.shiftleft(high, TIE_BITS).bitwiseOR(low)


def bytes_below(rows: DataFrame, probes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact bytes and rows with a key below each of the sorted probes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = np.zeros(len(probes) + 1, np.int64)
        count = np.zeros(len(probes) + 1, np.int64)
        for batch in batches:
            cell = np.searchsorted(probes, batch.column(0).to_numpy(), side="right")
            np.add.at(size, cell, batch.column(1).to_numpy())
            np.add.at(count, cell, 1)
        at = np.flatnonzero(count)
        yield pa.record_batch([pa.array(at), pa.array(size[at]), pa.array(count[at])], names=["cell", "bytes", "n"])

    found = rows.select("_wf_key", "_wf_size").mapInArrow(run, "cell long, bytes long, n long")
    size = np.zeros(len(probes) + 1, np.int64)
    count = np.zeros(len(probes) + 1, np.int64)
    for r in found.groupBy("cell").agg(F.sum("bytes"), F.sum("n")).collect():  # at most one row for each probe
        size[r[0]], count[r[0]] = r[1], r[2]
    return np.cumsum(size)[:-1], np.cumsum(count)[:-1]


def splitters(rows: DataFrame, targets: list[tuple[float, float]], total: int, probes_each: int = 7) -> list[int]:
    """Keys whose exact bytes below are within (target, tolerance), as near as whole rows allow."""
    n = len(targets)
    goal, slack = np.array([t for t, _ in targets]), np.array([s for _, s in targets])
    unit = 1 << TIE_BITS
    low, high = [0] * n, [TOP] * n
    low_b, high_b = np.zeros(n), np.full(n, float(total))
    chosen: list[int | None] = [None] * n
    while todo := [k for k in range(n) if chosen[k] is None]:
        wanted: dict[int, set[int]] = {}
        for k in todo:
            a, b = low[k], high[k]
            step = unit if b - a > unit else 1
            part = (goal[k] - low_b[k]) / max(1.0, high_b[k] - low_b[k])
            near = [a + (b - a) * j // (probes_each + 1) for j in range(1, probes_each + 1)]
            near += [a + int((b - a) * min(1.0, max(0.0, part + d))) for d in (-0.002, 0.0, 0.002)]
            wanted[k] = {p for x in near if a < (p := x // step * step) < b}
        probes = sorted(set().union(*wanted.values()))
        below, _ = bytes_below(rows, np.array(probes, np.int64)) if probes else (np.zeros(0), None)
        at = dict(zip(probes, below.tolist()))
        for k in todo:
            known = [(low[k], low_b[k]), (high[k], high_b[k]), *((p, float(at[p])) for p in wanted[k])]
            best = min(known, key=lambda x: (abs(x[1] - goal[k]), x[0]))
            aligned = best[0] % unit == 0
            if abs(best[1] - goal[k]) <= slack[k] and (aligned or high[k] - low[k] <= unit) or not wanted[k] and high[k] - low[k] <= 1:
                chosen[k] = best[0]
                continue
            low[k], low_b[k] = max((x for x in known if x[1] <= goal[k]), key=lambda x: x[0])
            high[k], high_b[k] = min((x for x in known if x[1] >= goal[k] and x[0] > low[k]), key=lambda x: x[0], default=(low[k], low_b[k]))
            if high[k] <= low[k] + 1:
                chosen[k] = min(((low[k], low_b[k]), (high[k], high_b[k])), key=lambda x: abs(x[1] - goal[k]))[0]
    return [int(x) for x in np.maximum.accumulate(np.array(chosen, dtype=object))] if chosen else []


def shard_rows(df: DataFrame, shards: int, size: Column, text: Column, row_id: Column, tolerance: float = 0.02, cell_bytes: int = 256 << 20) -> DataFrame:
    """df with shard (0 to shards - 1) and slot (gapless from 0 in each shard).

    tolerance: a shard's bytes differ from the mean by that share of it at
    most, but for rows that are larger. cell_bytes: about the most that one
    task sorts. A shard's cells, four at least, lie between quantiles of its
    keys from a mergeable summary. The driver holds the shards' splitters, and
    a key and a count for each cell.
    """
    spark = df.sparkSession
    scratch = Scratch(spark)
    keep = [c for c in df.columns if c not in ("shard", "slot")]
    given = df.select(F.struct(*(F.col(quoted(c)) for c in keep)).alias("row") if keep else F.struct(F.lit(1)).alias("row"), sort_key(text, row_id).alias("_wf_key"), F.coalesce(size.cast("long"), F.lit(0)).alias("_wf_size"))
    rows = scratch.table(given, "rows")
    total = int(rows.agg(F.sum("_wf_size")).first()[0] or 0)
    mean = total / shards
    ends = np.array([min(x, TOP - 1) for x in splitters(rows, [(mean * k, mean * tolerance / 2) for k in range(1, shards)], total)], np.int64)

    def placed(edges: np.ndarray, names: np.ndarray) -> Column:
        @F.pandas_udf("int")
        def place(key: pd.Series) -> pd.Series:
            return pd.Series(names[np.searchsorted(edges, key.to_numpy(), side="right")])

        return place("_wf_key")

    each = max(4, -(-total // (shards * cell_bytes)))
    inner = rows.select(placed(ends, np.arange(shards, dtype=np.int32)).alias("s"), "_wf_key").groupBy("s").agg(F.percentile_approx("_wf_key", [k / each for k in range(1, each)], 20 * each).alias("q")).collect()  # a list for each shard
    cuts = np.unique(np.concatenate([ends, *(np.array(r.q, np.int64) for r in inner)]))
    below = bytes_below(rows, cuts)[1] if len(cuts) else np.zeros(0, np.int64)
    before = np.concatenate([[0], below]).astype(np.int64)
    shard_of = np.concatenate([[0], np.searchsorted(ends, cuts, side="right")]).astype(np.int64)
    base = before - before[np.searchsorted(shard_of, shard_of)]
    keys = exact_keys(spark, len(base))
    places = spark.createDataFrame(list(zip(keys.tolist(), shard_of.tolist(), base.tolist())), "_wf_cell int, shard int, _wf_base long")

    moved = rows.withColumn("_wf_cell", placed(cuts, keys)).repartition(len(base), "_wf_cell")
    order = Window.partitionBy("_wf_cell").orderBy("_wf_key")
    numbered = moved.withColumn("_wf_row", F.row_number().over(order)).join(F.broadcast(places), "_wf_cell")
    return numbered.select(*(F.col("row")[c].alias(c) for c in keep), "shard", (F.col("_wf_base") + F.col("_wf_row") - 1).cast("long").alias("slot"))
