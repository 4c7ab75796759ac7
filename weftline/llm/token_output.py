"""Token ids as flat binary files, with 64-bit document offsets beside them.

Documents are put in ascending doc_id order by ranges of ids, so a part file
holds a run of neighbours: `part-NNNNNN-TAG.ids` (unsigned little-endian ids,
one document after another), `.off` (n + 1 unsigned 64-bit offsets, counted in
ids, from 0) and `.doc` (n signed 64-bit doc_ids). The parts' totals, added up,
are their bases in the whole sequence. The reader maps the files into memory; a
store without local paths is read by the ranges of ids that are asked for.

Nulls and empties: a null text is an empty one (its end id alone); rows whose
doc_id is null come first. Rows with the same doc_id are all written, in the
order of the table, and ranges may cut between them, so no id makes a part
large. An empty table writes no file. Other columns are ignored.
"""

from __future__ import annotations

import mmap
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import id_width
from .packing import encode_documents
from .runtime import Scratch, partition_bases

_PARTS = "part long, n_docs long, n_null long, n_tokens long, id_bytes int, attempt string"


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def write_ids(encoded: DataFrame, folder: str, parts: int, id_bytes: int = 2) -> DataFrame:
    """Write encoded documents (part, pos, doc_id, n_tokens, ids; a written table) as part files below folder.

    Returns one row for each part: part, n_docs, n_null (documents without id,
    the part's first), n_tokens, id_bytes, attempt (the part's file names hold
    it, so a task that runs twice never mixes its files).
    """
    order = [F.col("doc_id").asc_nulls_first(), F.col("part"), F.col("pos")]
    ordered = encoded.select("part", "pos", "doc_id", "n_tokens", "ids").repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        from pyspark import TaskContext

        where, root = _open(folder)
        where.create_dir(root, recursive=True)
        now, tag = TaskContext.get().partitionId(), uuid.uuid4().hex[:12]
        stem = f"{root}/part-{now:06d}-{tag}"
        out, n, null, total = None, 0, 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                out = [where.open_output_stream(f"{stem}.{kind}") for kind in ("ids", "off", "doc")]
                out[1].write(np.zeros(1, "<u8"))
            ends = total + np.cumsum(batch.column("n_tokens").to_numpy())
            for blob in batch.column("ids"):
                out[0].write(blob.as_buffer())
            out[1].write(ends.astype("<u8"))
            out[2].write(pc.fill_null(batch.column("doc_id"), 0).to_numpy().astype("<i8"))
            n, null, total = n + batch.num_rows, null + batch.column("doc_id").null_count, int(ends[-1])
        if out is not None:
            for f in out:
                f.close()
            yield pa.record_batch([pa.array([x], t) for x, t in ((now, pa.int64()), (n, pa.int64()), (null, pa.int64()), (total, pa.int64()), (id_bytes, pa.int32()), (tag, pa.string()))], names=["part", "n_docs", "n_null", "n_tokens", "id_bytes", "attempt"])

    return ordered.mapInArrow(run, _PARTS)


class IdFile:
    """One part, mapped into memory; from a store without local paths, offsets are read and ids by range."""

    def __init__(self, folder: str, part: int, attempt: str, id_bytes: int) -> None:
        self.where, root = _open(folder)
        self.stem = f"{root}/part-{part:06d}-{attempt}"
        self.kind = np.dtype({2: "<u2", 4: "<u4"}[id_bytes])
        self.local = isinstance(self.where, fs.LocalFileSystem)
        self.offsets = np.frombuffer(self._map(self.where, f"{self.stem}.off"), "<u8")
        self.docs = np.frombuffer(self._map(self.where, f"{self.stem}.doc"), "<i8")
        self.ids = np.frombuffer(self._map(self.where, f"{self.stem}.ids"), self.kind) if self.local else None

    @staticmethod
    def _map(where: fs.FileSystem, path: str):
        if isinstance(where, fs.LocalFileSystem):
            with open(path, "rb") as f:
                return mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ) if os.fstat(f.fileno()).st_size else b""
        with where.open_input_file(path) as f:
            return f.read_buffer()

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def __getitem__(self, k: int) -> np.ndarray:
        return self.between(k, k + 1)[0]

    def between(self, lo: int, hi: int) -> list[np.ndarray]:
        """The ids of each document from lo to hi."""
        edge = self.offsets[lo : hi + 1].astype(np.int64)
        if self.local:
            run = self.ids[edge[0] : edge[-1]]
        else:
            with self.where.open_input_file(f"{self.stem}.ids") as f:
                run = np.frombuffer(f.read_at(int(edge[-1] - edge[0]) * self.kind.itemsize, int(edge[0]) * self.kind.itemsize), self.kind)
        return [run[a:z] for a, z in zip((edge[:-1] - edge[0]).tolist(), (edge[1:] - edge[0]).tolist())]


def read_ids(parts: DataFrame, folder: str) -> DataFrame:
    """The documents of a written set, from its files: doc_id, start, n_tokens, ids_crc32, ids."""
    bases = partition_bases(parts, "part", "n_tokens")
    table = parts.sparkSession.createDataFrame(list(bases.items()), "part long, base long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():  # a row for each part
                file, lo = IdFile(folder, row["part"], row["attempt"], row["id_bytes"]), 0
                while lo < len(file):
                    hi = max(lo + 1, int(np.searchsorted(file.offsets, file.offsets[lo] + np.uint64(1 << 20), side="right")) - 1)
                    hi = min(hi, len(file), lo + 10_000)
                    own = file.between(lo, hi)
                    yield pa.record_batch(
                        [
                            pa.array(file.docs[lo:hi], pa.int64(), mask=np.arange(lo, hi) < row["n_null"]),
                            pa.array(row["base"] + file.offsets[lo:hi].astype(np.int64)),
                            pa.array([len(x) for x in own], pa.int64()),
                            pa.array([zlib.crc32(x.astype("<u4")) for x in own], pa.int64()),
                            pa.array([x.tobytes() for x in own], pa.binary()),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"],
                    )
                    lo = hi

    spread_out = parts.repartition(max(1, parts.count()), "part").join(F.broadcast(table), "part")
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary"
    return spread_out.select("part", "attempt", "id_bytes", "n_null", "base").mapInArrow(run, schema)


def export_ids(docs: DataFrame, tokenizer: str, end_id: int = 1, part_tokens: int = 16 << 20, id_col: str = "doc_id", text_col: str = "text", folder: str | None = None) -> tuple[DataFrame, str]:
    """Encode docs and write them below folder (by default in the shared folder): the parts' table, and the folder."""
    scratch = Scratch(docs.sparkSession)
    folder = folder or scratch.path("ids")
    width = id_width(tokenizer, end_id)
    encoded = scratch.table(encode_documents(docs, tokenizer, end_id, id_col, text_col, width), "encoded")
    total = encoded.agg(F.sum("n_tokens")).first()[0] or 0
    least = min(48, 2 * docs.sparkSession.sparkContext.defaultParallelism)
    parts = scratch.table(write_ids(encoded, folder, max(least, -(-total // part_tokens)), width), "parts")
    scratch.drop("encoded")
    return parts, folder
