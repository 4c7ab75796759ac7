"""Packing by concatenate and cut.

Pass one encodes every document once and writes its ids with the start inside
its partition. The partitions' token totals give bases by prefix sums. Pass two
adds the base, so each document knows its place in the one long id sequence
and cuts itself at multiples of the window: no shuffle and no sort at all.
Windows that span partitions are told by their boundary pieces.

Nulls and empties: a null text is an empty one and becomes its end id alone; a
null doc_id is carried along. Repeated rows are packed once for each row. An
empty table gives no pieces. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import WordEncoder, id_width
from .runtime import Scratch, partition_bases, quoted
from .textkern import slices, spread

_ENCODED = "part int, pos long, local_start long, doc_id long, n_tokens long, ids binary"


def encode_documents(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", id_bytes: int | None = None) -> DataFrame:
    """One row for each row of docs: its ids (little-endian, of id_bytes bytes each) with end_id last.

    id_bytes: by default 2 where vocabulary and end_id allow it, else 4; a
    width that doesn't hold them is an error.
    part and pos number partitions and rows in them, local_start counts the
    partition's ids before the row. Write the result before using them.
    """
    least = id_width(tokenizer, end_id)
    if id_bytes is not None and id_bytes < least:
        raise ValueError(f"ids of this vocabulary need {least} bytes")
    ids_type = np.dtype({2: np.uint16, 4: np.uint32}[id_bytes or least])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, part = WordEncoder(tokenizer), TaskContext.get().partitionId()
        pos = start = 0
        for batch in batches:
            for s in slices(batch.column(1)):
                ids, n = encoder.encode(s)
                ends = np.cumsum(n + 1)
                out = np.empty(int(ends[-1]), ids_type)
                out[ends - 1] = end_id
                out[spread(ends - 1 - n, n)] = ids
                offsets = np.concatenate([[0], ends]) * ids_type.itemsize
                binary = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(s), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(out)])
                yield pa.record_batch(
                    [
                        pa.array(np.full(len(s), part, np.int32)),
                        pa.array(np.arange(pos, pos + len(s))),
                        pa.array(start + ends - n - 1),
                        batch.column(0).slice(s.first, len(s)),
                        pa.array(n + 1),
                        binary.cast(pa.binary()),
                    ],
                    names=["part", "pos", "local_start", "doc_id", "n_tokens", "ids"],
                )
                pos += len(s)
                start += int(ends[-1])

    return docs.select(F.col(quoted(id_col)).cast("long").alias("doc_id"), F.col(quoted(text_col)).alias("text")).mapInArrow(run, _ENCODED)


def with_starts(encoded: DataFrame) -> DataFrame:
    """Add start: the ids of all rows before, by prefix sums over the partitions' totals."""
    bases = partition_bases(encoded, "part", "n_tokens")
    spark = encoded.sparkSession
    table = spark.createDataFrame([(k, v) for k, v in bases.items()], "part int, base long")
    return encoded.join(F.broadcast(table), "part").withColumn("start", F.col("base") + F.col("local_start")).drop("base", "local_start")


def cut(placed: DataFrame, window: int) -> DataFrame:
    """The pieces of placed documents: windows are [k * window, (k + 1) * window).

    boundary marks pieces whose window began in an earlier row or goes on in a
    later one; the pieces of such a window share its sequence_id.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start = batch.column("start").to_numpy()
            n = batch.column("n_tokens").to_numpy()
            width = batch.column("ids").type
            first, last = start // window, (start + n - 1) // window
            count = last - first + 1
            row = np.repeat(np.arange(len(n)), count)
            seq = spread(first, count)
            lo = np.maximum(seq * window, start[row])
            hi = np.minimum((seq + 1) * window, (start + n)[row])
            blobs = batch.column("ids")
            crc, ids = [], []
            for r, a, b in zip(row.tolist(), (lo - start[row]).tolist(), (hi - start[row]).tolist()):
                part = blobs[r].as_buffer()
                size = part.size // int(n[r])
                piece = memoryview(part)[a * size : b * size]
                ids.append(bytes(piece))
                crc.append(zlib.crc32(piece if size == 4 else np.frombuffer(piece, np.uint16).astype("<u4")))
            yield pa.record_batch(
                [
                    batch.column("doc_id").take(pa.array(row)),
                    pa.array(lo - start[row]),
                    pa.array(hi - lo),
                    pa.array(crc, pa.int64()),
                    pa.array(n[row]),
                    pa.array(seq),
                    pa.array(lo - seq * window),
                    pa.array((lo > seq * window) | (hi < (seq + 1) * window)),
                    pa.array(ids, width),
                ],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "boundary", "ids"],
            )

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, boundary boolean, ids binary"
    return placed.select("doc_id", "start", "n_tokens", "ids").mapInArrow(run, schema)


def pack(docs: DataFrame, tokenizer: str, window: int = 4096, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of docs packed into windows of window ids; only the very last window is padded.

    Columns: doc_id, start, length, ids_crc32 (of little-endian 32-bit ids),
    doc_tokens, sequence_id, offset, boundary, ids (unsigned 16-bit, or 32-bit
    for larger vocabularies).
    """
    scratch = Scratch(docs.sparkSession)
    encoded = scratch.table(encode_documents(docs, tokenizer, end_id, id_col, text_col), "encoded")
    return cut(with_starts(encoded), window)


def windows(pieces: DataFrame, window: int = 4096, pad_id: int = 0, pad_last_to_power_of_two: bool = False) -> DataFrame:
    """Whole sequences (sequence_id, ids array) from pack()'s pieces.

    A window holds window ids at most, so a group is bounded. The last one is
    padded with pad_id to the window, or to the next power of two.
    """

    def run(keys, group):
        group = group.sort_by("offset")
        raw, n = b"".join(x.as_py() for x in group.column("ids")), sum(group.column("length").to_pylist())
        ids = np.frombuffer(raw, {2: np.uint16, 4: np.uint32}[len(raw) // n]).astype(np.int32)
        goal = window
        if pad_last_to_power_of_two and len(ids) < window:
            goal = min(window, 1 << max(0, len(ids) - 1).bit_length())
        ids = np.concatenate([ids, np.full(goal - len(ids), pad_id, np.int32)])
        return pa.table({"sequence_id": pa.array([keys[0].as_py()], pa.int64()), "ids": pa.array([ids], pa.list_(pa.int32()))})

    schema = T.StructType([T.StructField("sequence_id", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return pieces.select("sequence_id", "offset", "length", "ids").groupBy("sequence_id").applyInArrow(run, schema)
