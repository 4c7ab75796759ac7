"""Vectorised word splitting and hashing over Arrow string buffers.

Everything here is plain numpy over a slice of a batch, so a Python worker
handles about 100 ns a word instead of a microsecond, in bounded memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_P = 0x2545F4914F6CDD1D | 1
_P_INV = pow(_P, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, elementwise."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def combine(*parts: np.ndarray) -> np.ndarray:
    """One hash of equally long hash arrays, order-dependent."""
    out = mix(parts[0] + _GOLD)
    for p in parts[1:]:
        out = mix(out * np.uint64(_P) + p)
    return out


def table(word_bytes: set[int] | None = None, space: bytes = b"") -> np.ndarray:
    """A 256-entry mask of bytes that belong to words."""
    mask = np.zeros(256, bool)
    if word_bytes is None:
        mask[:] = True
        mask[list(space)] = False
    else:
        mask[list(word_bytes)] = True
    return mask


#: Words [^\x20\x09-\x0D]+, and words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing.
NON_SPACE = table(space=bytes([0x20, *range(0x09, 0x0E)]))
ALNUM = table(word_bytes={*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)})
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
_BYTES = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _GOLD)
_FOLDED = _BYTES[LOWER]
_powers: dict[int, np.ndarray] = {}


def _pow(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + (1 << 18))
        have = np.full(size, np.uint64(base))
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if size > 2 * SLICE_BYTES:
            return have
        _powers[base] = have
    return have[:n]


class Slice:
    """Some rows of a batch: blob holds each text and one newline after it."""

    def __init__(self, blob: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: int) -> None:
        self.blob, self.starts, self.ends, self.first = blob, starts, ends, first

    def __len__(self) -> int:
        return len(self.starts)

    def words(self, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end byte of each word, and the row of the slice that it is in."""
        inside = np.zeros(len(self.blob) + 2, np.int8)
        inside[1:-1] = mask[self.blob]
        step = np.diff(inside)
        at, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        return at, end, np.searchsorted(self.starts, at, side="right") - 1

    def hashes(self, at: np.ndarray, end: np.ndarray, fold: bool = True) -> np.ndarray:
        """A 64-bit hash of the bytes of each word; fold: A-Z count as a-z."""
        n = len(self.blob)
        sums = np.zeros(n + 1, np.uint64)
        np.take(_FOLDED if fold else _BYTES, self.blob, out=sums[1:], mode="clip")
        sums[1:] *= _pow(_P, n)
        np.cumsum(sums[1:], out=sums[1:])
        h = (sums[end] - sums[at]) * _pow(_P_INV, n + 1)[at]
        return mix(h + (end - at).astype(np.uint64) * _GOLD)


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """Cut a string column into slices of about limit bytes; nulls count as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    cum = np.cumsum(sizes + 1)
    row = 0
    while row < n:
        base = cum[row - 1] if row else 0
        stop = max(row + 1, int(np.searchsorted(cum, base + limit, side="right")))
        part = pc.fill_null(column.slice(row, stop - row).cast(pa.large_string()), "")
        part = pc.binary_join_element_wise(part, pa.scalar("", pa.large_string()), pa.scalar("\n", pa.large_string()))
        _, off, data = part.buffers()
        offsets = np.frombuffer(off, np.int64)[part.offset : part.offset + len(part) + 1]
        blob = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
        offsets = offsets - offsets[0]
        yield Slice(blob, offsets[:-1], offsets[1:] - 1, row)
        row = stop


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indices starts[i], starts[i]+1, ... (counts[i] of them), one after another."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    out = np.ones(total, np.int64)
    keep = counts > 0
    s, c = starts[keep], counts[keep]
    edge = np.cumsum(c)[:-1]
    out[0] = s[0]
    out[edge] = s[1:] - (s[:-1] + c[:-1] - 1)
    return np.cumsum(out)


class HashTable:
    """Open addressing from 64-bit hashes to int64 values, looked up by whole arrays.

    It holds at most limit keys; beyond that it starts anew, so it is a cache
    of bounded size whatever the number of distinct words.
    """

    def __init__(self, bits: int = 20) -> None:
        self.bits = bits
        self.mask = np.uint64((1 << bits) - 1)
        self.limit = 1 << (bits - 1)
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(1 << self.bits, np.uint64)
        self.values = np.full(1 << self.bits, -1, np.int64)
        self.size = 0

    def get(self, h: np.ndarray) -> np.ndarray:
        """Values of h, -1 where absent."""
        slot = h & self.mask
        found = self.values[slot]
        hit = self.keys[slot] == h
        out = np.where(hit, found, -1)
        todo = np.flatnonzero(~hit & (found >= 0))
        slot = slot[todo]
        while len(todo):
            slot = (slot + np.uint64(1)) & self.mask
            found = self.values[slot]
            hit = (self.keys[slot] == h[todo]) & (found >= 0)
            out[todo[hit]] = found[hit]
            more = ~hit & (found >= 0)
            todo, slot = todo[more], slot[more]
        return out

    def put(self, h: np.ndarray, values: np.ndarray) -> None:
        """Add distinct absent keys: of those that want one free slot the first gets it, the others go on."""
        slot = h & self.mask
        todo = np.arange(len(h))
        while len(todo):
            own = slot[todo]
            free = np.flatnonzero(self.values[own] < 0)
            at, first = np.unique(own[free], return_index=True)
            won = todo[free[first]]
            self.keys[at], self.values[at] = h[won], values[won]
            left = np.ones(len(todo), bool)
            left[free[first]] = False
            todo = todo[left]
            slot[todo] = (slot[todo] + np.uint64(1)) & self.mask
        self.size += len(h)
