"""Token counts without token ids.

1. Blocks of documents (Arrow slices of about block_bytes) are cut into
   pre-tokens. A block is one row of a written table: its distinct pre-tokens,
   and the frequencies of its documents, factored by words, as a word always
   falls into the same pre-tokens.
2. A block sends its pre-tokens of each hash bucket as one row. Buckets are
   exchanged, and the library counts the pieces of each distinct pre-token of a
   bucket, so of the corpus, once.
3. These counts are joined to the blocks, each of which adds them up by its
   documents' frequencies.

A pre-token goes once from each block that holds it, and each bucket gets one
row a block at most, so common ones aren't hot, and texts are never moved. A
task holds one block, or one bucket's distinct pre-tokens, at a time.

Nulls and empties: a null text is an empty one, of no bytes and no tokens; a
null doc_id is carried along; repeated rows are counted each. An empty table
gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import BYTE_RULES, Library, as_letters, follows, load
from .runtime import Scratch, quoted
from .textkern import NON_SPACE, Slice, mix, slices

_SPLIT = regex.compile(r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: In texts with other characters the library itself finds the pre-tokens.
_LATIN = re.compile(r" ?[\x21-\x7e¡-ɏ]*\Z")
_SPACED = mix(np.array([0x20], np.uint64))[0]
_BLOCK = "block long, sent array<struct<bucket:int,pretokens:string>>, doc_ids array<long>, n_bytes array<long>, n_special binary, sizes binary, members binary, places binary, freqs binary"
_PAYLOAD = ["block", "doc_ids", "n_bytes", "n_special", "sizes", "members", "places", "freqs"]


def squeeze(a: np.ndarray) -> bytes:
    """Non-negative integers, compressed, in the narrowest width that holds them."""
    narrow = a.astype(np.min_scalar_type(int(a.max(initial=0))))
    return bytes([narrow.itemsize]) + zstandard.compress(narrow.tobytes(), 1)


def unsqueeze(raw: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(raw[1:]), f"u{raw[0]}").astype(np.int64)


class PreTokens:
    """Pre-tokens of whole slices of text, for a byte-level vocabulary that keeps white space."""

    def __init__(self, path: str, buckets: int) -> None:
        self.lib = load(path)
        self.buckets = buckets
        self.specials = [t.content for t in self.lib.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, self.specials))) if self.specials else None

    def of_word(self, word: str) -> list[str]:
        """Pre-tokens of a word with the space before it, if any."""
        if _LATIN.match(word):
            return [as_letters(x) for x in _SPLIT.findall(word)]
        return [x for x, _ in self.lib.pre_tokenizer.pre_tokenize_str(word)]

    def block(self, s: Slice) -> tuple[list[int], list[str], list[bytes]]:
        """The slice's buckets, the distinct pre-tokens of each (between spaces), and n_special, sizes, members, places and freqs.

        Pre-tokens are numbered in the order of the buckets. Entry k of sizes
        is the number of pre-tokens of word k, which members list one after
        another; places are the steps between the ascending document * words +
        word, and freqs how often that word is there.
        """
        blob = s.blob
        raw = blob.tobytes()
        special = np.zeros(len(s), np.int64)
        at, end, doc = s.words(NON_SPACE)
        spaced = (at > s.starts[doc]) & (blob[np.maximum(at - 1, 0)] == 0x20)
        h = s.hashes(at, end, fold=False)
        _, first, word = np.unique(np.where(spaced, mix(h ^ _SPACED), h), return_index=True, return_inverse=True)
        runs = zip((at[first] - spaced[first]).tolist(), end[first].tolist())
        words = [self.of_word(raw[a:e].decode("utf-8", "replace")) for a, e in runs]
        # Pre-tokens found by other means count as words of their own.
        extra_doc, extra = self._gaps(s, at, end, doc)
        whole = self._odd(s, raw)
        empty = np.ones(len(s), bool)
        empty[doc] = False
        whole |= empty & (s.ends > s.starts)
        plain, kept = ~whole[doc], ~whole[np.array(extra_doc, np.int64)]
        extra_doc, extra = [d for d, k in zip(extra_doc, kept) if k], [x for x, k in zip(extra, kept) if k]
        for k in np.flatnonzero(whole).tolist():
            text = raw[s.starts[k] : s.ends[k]].decode("utf-8", "replace")
            parts = self.special.split(text) if self.special else [text]
            special[k] = len(parts) - 1
            found = [x for p in parts if p for x, _ in self.lib.pre_tokenizer.pre_tokenize_str(p)]
            extra_doc += [k] * len(found)
            extra += found
        own: dict[str, int] = {}
        extra_word = np.array([len(words) + own.setdefault(x, len(own)) for x in extra], np.int64)
        words += [[x] for x in own]
        in_doc, in_word = np.concatenate([doc[plain], np.array(extra_doc, np.int64)]), np.concatenate([word[plain], extra_word])
        in_word, used = self._renumber(in_doc, in_word, len(words))
        places, freqs = np.unique(in_doc * max(len(used), 1) + in_word, return_counts=True)
        number: dict[str, int] = {}
        members = np.fromiter((number.setdefault(x, len(number)) for k in used for x in words[k]), np.int64)
        sizes = np.fromiter((len(words[k]) for k in used), np.int64, len(used))
        # Written by letters only, a pre-token holds no space.
        bucket = np.fromiter((zlib.crc32(x.encode()) % self.buckets for x in number), np.int64, len(number))
        order = np.argsort(bucket, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        names = list(number)
        found, first = np.unique(bucket[order], return_index=True)
        sent = [" ".join([names[k] for k in part]) for part in np.split(order, first[1:])] if names else []
        return found.tolist(), sent, [squeeze(x) for x in (special, sizes, place[members], np.diff(places, prepend=0), freqs)]

    def _renumber(self, in_doc: np.ndarray, in_word: np.ndarray, n: int) -> tuple[np.ndarray, list[int]]:
        """New numbers of the words, and the old number of each: common words come first, then in the documents' order.

        Steps between a document's words are small then: a document's rare words follow each other.
        """
        freq = np.bincount(in_word, minlength=n)
        first = np.full(n, len(in_doc))
        np.minimum.at(first, in_word, in_doc)
        used = np.lexsort((first, -freq))[: np.count_nonzero(freq)]
        new = np.zeros(n, np.int64)
        new[used] = np.arange(len(used))
        return new[in_word], used.tolist()

    def _gaps(self, s: Slice, at: np.ndarray, end: np.ndarray, doc: np.ndarray) -> tuple[list[int], list[str]]:
        """White space that isn't the one space before a word: the documents and pre-tokens."""
        docs, out = [], []

        def add(d: int, gap: str) -> None:
            if gap:
                docs.append(d)
                out.append(as_letters(gap))

        opens = np.concatenate([[True], doc[1:] != doc[:-1]])[: len(doc)]
        lo = np.where(opens, s.starts[doc], np.concatenate([[0], end[:-1]])[: len(doc)])
        k = at - lo
        for g in np.flatnonzero((k > 1) | ((k == 1) & (s.blob[np.maximum(at - 1, 0)] != 0x20))).tolist():
            gap = s.blob[lo[g] : at[g]].tobytes().decode("ascii")
            add(int(doc[g]), gap[:-1])
            add(int(doc[g]), gap[-1] if gap[-1] != " " else "")
        last = np.concatenate([doc[1:] != doc[:-1], [True]])[: len(doc)]
        tail = s.ends[doc[last]] - end[last]
        for g in np.flatnonzero(tail > 0).tolist():
            e = int(end[last][g])
            add(int(doc[last][g]), s.blob[e : e + int(tail[g])].tobytes().decode("ascii"))
        return docs, out

    def _odd(self, s: Slice, raw: bytes) -> np.ndarray:
        """Rows that hold a special string, or white space beyond ASCII, whose runs span words."""
        b = s.blob
        nxt = np.append(b[1:], 0)
        hit = (b >= 0x1C) & (b <= 0x1F)
        hit |= (b == 0xC2) & ((nxt == 0x85) | (nxt == 0xA0))
        hit |= ((b == 0xE1) & (nxt == 0x9A)) | ((b == 0xE2) & ((nxt == 0x80) | (nxt == 0x81))) | ((b == 0xE3) & (nxt == 0x80))
        odd = np.zeros(len(s), bool)
        odd[np.searchsorted(s.starts, np.flatnonzero(hit), side="right") - 1] = True
        for special in self.specials:
            odd[np.searchsorted(s.starts, np.array([m.start() for m in re.finditer(re.escape(special.encode()), raw)], np.int64), side="right") - 1] = True
        return odd


def cut_blocks(docs: DataFrame, tokenizer: str, block_bytes: int, buckets: int, id_col: str, text_col: str) -> DataFrame:
    """One row for each block of docs; write it before use, as it numbers the blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = PreTokens(tokenizer, buckets)
        block = TaskContext.get().partitionId() << 33
        for batch in batches:
            for s in slices(batch.column(1), block_bytes):
                numbers, sent, columns = split.block(s)
                rows = pa.StructArray.from_arrays([pa.array(numbers, pa.int32()), pa.array(sent, pa.string())], ["bucket", "pretokens"])
                ids = pa.ListArray.from_arrays(pa.array([0, len(s)], pa.int32()), batch.column(0).slice(s.first, len(s)))
                lists = [pa.array([block], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(sent)], pa.int32()), rows), ids, pa.array([s.ends - s.starts], pa.list_(pa.int64()))]
                yield pa.record_batch([*lists, *(pa.array([c], pa.binary()) for c in columns)], names=["block", "sent", *_PAYLOAD[1:]])
                block += 1

    return docs.select(F.col(quoted(id_col)).cast("long").alias("doc_id"), F.col(quoted(text_col)).alias("text")).mapInArrow(run, _BLOCK)


def count_pieces(sent: DataFrame, tokenizer: str) -> DataFrame:
    """sent (of_block, bucket, pretokens) with n, the pieces of each of pretokens, in their place.

    The rows of a bucket follow each other in a sorted partition.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(tokenizer).model
        now, known = None, {}
        for batch in batches:
            held, out = [], []
            for bucket, pretokens in zip(batch.column("bucket").to_pylist(), batch.column("pretokens").to_pylist()):
                if bucket != now:
                    now, known = bucket, {}
                names = pretokens.split(" ")
                for x in names:
                    if x not in known:
                        known[x] = len(model.tokenize(x))
                n = [known[x] for x in names]
                held.append(len(n))
                out.append(np.array(n, "u1" if max(n) < 255 else "u4").tobytes())
            yield pa.record_batch([batch.column("of_block"), batch.column("bucket"), pa.array(held, pa.int32()), pa.array(out, pa.binary())], names=["of_block", "bucket", "held", "n"])

    return sent.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, "of_block long, bucket int, held int, n binary")


def _add_up(block: pa.Table, counted: pa.Table) -> pa.Table:
    """The counts of one block's documents, from its row and the pieces of its pre-tokens."""
    row = {c: block.column(c)[0] for c in _PAYLOAD}
    special, sizes, members, steps, freqs = (unsqueeze(row[c].as_py()) for c in _PAYLOAD[3:])
    counted = counted.sort_by("bucket")
    parts = zip(counted.column("n").to_pylist(), counted.column("held").to_pylist())
    pieces = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(raw, f"u{len(raw) // held}").astype(np.int64) for raw, held in parts)])
    words = np.bincount(np.repeat(np.arange(len(sizes)), sizes), weights=pieces[members], minlength=len(sizes)).astype(np.int64)
    doc, word = np.divmod(np.cumsum(steps), max(len(sizes), 1))
    n = np.bincount(doc, weights=freqs * words[word], minlength=len(special)).astype(np.int64) + special
    return pa.table({"doc_id": row["doc_ids"].values, "n_bytes": row["n_bytes"].values, "n_tokens": pa.array(n)})


def _whole_texts(docs: DataFrame, tokenizer: str, id_col: str, text_col: str) -> DataFrame:
    """doc_id, n_bytes and n_tokens by the vocabulary's library, text by text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lib = Library(tokenizer)
        for batch in batches:
            for s in slices(batch.column(1)):
                n = [len(ids) for ids in lib.of_slice(s)]
                yield pa.record_batch([batch.column(0).slice(s.first, len(s)), pa.array(s.ends - s.starts), pa.array(n, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col(quoted(id_col)).cast("long").alias("doc_id"), F.col(quoted(text_col)).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")


def count_tokens(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = 8 << 20, buckets: int = 4096) -> DataFrame:
    """doc_id, n_bytes (UTF-8) and n_tokens of each row of docs.

    buckets bounds the tasks that count pieces, and a bucket's distinct
    pre-tokens are held by one of them: raise it with the corpus. A vocabulary
    that doesn't follow BYTE_RULES has other pre-tokens: its library counts whole texts.
    """
    if not follows(tokenizer, BYTE_RULES):
        return _whole_texts(docs, tokenizer, id_col, text_col)
    blocks = Scratch(docs.sparkSession).table(cut_blocks(docs, tokenizer, block_bytes, buckets, id_col, text_col), "blocks")
    sent = blocks.select(F.col("block").alias("of_block"), F.inline("sent"))
    return blocks.select(_PAYLOAD).groupBy("block").cogroup(count_pieces(sent, tokenizer).groupBy("of_block")).applyInArrow(_add_up, "doc_id long, n_bytes long, n_tokens long")
