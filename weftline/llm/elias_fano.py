"""Elias-Fano sequences and an n-gram trie in flat levels that can be mapped into memory."""

from __future__ import annotations

import json

import numpy as np

_COUNT8 = np.array([bin(b).count("1") for b in range(256)], np.int64)
#: _SELECT8[b, k]: place of the k-th set bit of byte b
_SELECT8 = np.zeros((256, 8), np.int64)
for _b in range(256):
    for _k, _p in enumerate([p for p in range(8) if _b >> p & 1]):
        _SELECT8[_b, _k] = _p
#: Every second bit, every second pair of bits, every second four; the lowest and the highest bit of each byte.
_EVEN, _PAIRS, _FOURS, _ONES, _TOPS = (np.uint64(b * 0x0101010101010101) for b in (0x55, 0x33, 0x0F, 0x01, 0x80))
_ALL = np.uint64(2**64 - 1)


class EliasFano:
    """An ascending sequence of n integers below universe, in about 2 + log2(universe / n) bits each."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, ones: np.ndarray) -> None:
        self.n, self.low_bits, self.low, self.high, self.ones = n, low_bits, low, high, ones
        self.zeros = np.arange(len(ones), dtype=np.int64) * 64 - ones

    @classmethod
    def encode(cls, values: np.ndarray, universe: int) -> EliasFano:
        values = values.astype(np.uint64)
        n = len(values)
        low_bits = max(0, (max(1, universe) // max(1, n)).bit_length() - 1)
        shift = np.uint64(low_bits)
        top = (values >> shift).astype(np.int64)
        words = ((universe >> low_bits) + n + 2) // 64 + 1
        bits = np.zeros(words * 64, bool)
        bits[top + np.arange(n)] = True
        high = np.packbits(bits, bitorder="little").view(np.uint64)
        ones = np.concatenate([[0], np.cumsum(_COUNT8[high.view(np.uint8)].reshape(-1, 8).sum(1))])
        low = np.zeros(n * low_bits // 64 + 2, np.uint64)
        if low_bits:
            rest = values & ((np.uint64(1) << shift) - np.uint64(1))
            at = np.arange(n, dtype=np.int64) * low_bits
            word, off = at >> 6, (at & 63).astype(np.uint64)
            np.bitwise_or.at(low, word, rest << off)
            over = (at & 63) + low_bits > 64
            np.bitwise_or.at(low, word[over] + 1, rest[over] >> (np.uint64(64) - off[over]))
        return cls(n, low_bits, low, high, ones)

    def _select(self, k: np.ndarray, before: np.ndarray, flip: np.uint64) -> np.ndarray:
        """Place of the k-th bit that is set (flip 0) or unset (flip all ones): within its word by sums over all its bytes at once."""
        word = np.searchsorted(before, k, side="right") - 1
        rest = (k - before[word]).astype(np.uint64)
        bits = self.high[word] ^ flip
        pairs = bits - ((bits >> np.uint64(1)) & _EVEN)
        fours = (pairs & _PAIRS) + ((pairs >> np.uint64(2)) & _PAIRS)
        upto = ((fours + (fours >> np.uint64(4))) & _FOURS) * _ONES
        byte = np.bitwise_count(((rest * _ONES | _TOPS) - upto) & _TOPS).astype(np.uint64) << np.uint64(3)
        rest -= ((upto << np.uint64(8)) >> byte) & np.uint64(255)
        return word * 64 + byte.astype(np.int64) + _SELECT8[((bits >> byte) & np.uint64(255)).astype(np.int64), rest.astype(np.int64)]

    def _low(self, k: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(k), np.uint64)
        at = k * self.low_bits
        word, off = at >> 6, (at & 63).astype(np.uint64)
        value = self.low[word] >> off
        over = off > 0
        value = value | np.where(over, self.low[word + 1] << ((np.uint64(64) - off) & np.uint64(63)), np.uint64(0))
        return value & ((np.uint64(1) << np.uint64(self.low_bits)) - np.uint64(1))

    def __getitem__(self, k: np.ndarray) -> np.ndarray:
        """Values at places k."""
        top = (self._select(k, self.ones[:-1], np.uint64(0)) - k).astype(np.uint64)
        return top << np.uint64(self.low_bits) | self._low(k)

    def _before(self, top: np.ndarray) -> np.ndarray:
        """How many values have a high part below top."""
        out = np.zeros(len(top), np.int64)
        some = np.flatnonzero(top > 0)
        k = np.minimum(top[some], int(self.zeros[-1])) - 1
        out[some] = self._select(k, self.zeros[:-1], _ALL) - k
        return np.minimum(out, self.n)

    def successor(self, x: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """The first place in [lo, hi) whose value is x or more, else hi."""
        x = x.astype(np.uint64)
        top = (x >> np.uint64(self.low_bits)).astype(np.int64)
        rest = x & ((np.uint64(1) << np.uint64(self.low_bits)) - np.uint64(1))
        a, b = np.clip(self._before(top), lo, hi), np.clip(self._before(top + 1), lo, hi)
        live = np.flatnonzero(a < b)
        while len(live):
            mid = (a[live] + b[live]) >> 1
            less = self._low(mid) < rest[live]
            a[live] = np.where(less, mid + 1, a[live])
            b[live] = np.where(less, b[live], mid)
            live = live[a[live] < b[live]]
        return a

    def parts(self) -> dict[str, np.ndarray]:
        return {"head": np.array([self.n, self.low_bits], np.int64), "low": self.low, "high": self.high, "ones": self.ones}

    @classmethod
    def of(cls, parts: dict[str, np.ndarray]) -> EliasFano:
        return cls(int(parts["head"][0]), int(parts["head"][1]), parts["low"], parts["high"], parts["ones"])


#: Probabilities are kept as codes of their logarithm to base 2, in steps of 1 / QUANT.
QUANT = 1024


def quantise(p: np.ndarray) -> np.ndarray:
    """16-bit codes of probabilities from 2^-63 to 1; 65535 stands for 0."""
    with np.errstate(divide="ignore"):
        return np.where(p > 0, np.clip(np.rint(-np.log2(np.maximum(p, 2.0**-63)) * QUANT), 0, 65534), 65535).astype(np.uint16)


def dequantise(code: np.ndarray) -> np.ndarray:
    return np.where(code == 65535, 0.0, np.exp2(-code.astype(np.float64) / QUANT))


class Level:
    """What follows each node of the level above it.

    first: where a node's followers begin. followers: for each node its
    followers' numbers as names, ascending, on top of the last value of the
    node before, so that the whole level ascends. Two rows of codes: share of
    each follower, and what each node above leaves to the lower order.
    """

    def __init__(self, first: EliasFano, followers: EliasFano, share: np.ndarray, rest: np.ndarray) -> None:
        self.first, self.followers, self.share, self.rest = first, followers, share, rest

    @classmethod
    def build(cls, nodes: int, node: np.ndarray, follower: np.ndarray, times: np.ndarray) -> Level:
        """node (of the level above, which has nodes of them) and follower ascend as pairs.

        Witten-Bell smoothing: of what follows a node c times, as d kinds of
        word, a kind seen t times gets t / (c + d), and d / (c + d) is left.
        """
        kinds = np.bincount(node, minlength=nodes)
        total = np.maximum(np.bincount(node, weights=times, minlength=nodes) + kinds, 1)
        first = np.concatenate([[0], np.cumsum(kinds)])
        steps = np.zeros(nodes, np.int64)
        steps[kinds > 0] = follower[first[1:][kinds > 0] - 1]
        base = np.cumsum(steps) - steps
        values = EliasFano.encode(follower + base[node], int(steps.sum()) + 1)
        return cls(EliasFano.encode(first, len(node) + 1), values, quantise(times / total[node]), quantise(np.where(kinds > 0, kinds / total, 1.0)))

    def kinds(self, node: np.ndarray) -> np.ndarray:
        """How many kinds of word follow each node, none where it is -1."""
        out = np.zeros(len(node), np.int64)
        ok = np.flatnonzero(node >= 0)
        out[ok] = (self.first[node[ok] + 1] - self.first[node[ok]]).astype(np.int64)
        return out

    def find(self, node: np.ndarray, width: np.ndarray, follower: np.ndarray) -> np.ndarray:
        """Places of followers, width[i] of them asked of node[i]; -1 where node or follower are, and where it doesn't follow."""
        lo, hi, base = np.zeros(len(node), np.int64), np.zeros(len(node), np.int64), np.zeros(len(node), np.uint64)
        ok = np.flatnonzero(node >= 0)
        lo[ok], hi[ok] = self.first[node[ok]], self.first[node[ok] + 1]
        some = np.flatnonzero((hi > lo) & (lo > 0))
        base[some] = self.followers[lo[some] - 1]
        out = np.full(len(follower), -1)
        row = np.flatnonzero(np.repeat(hi > lo, width) & (follower >= 0))
        own = np.repeat(np.arange(len(node)), width)[row]
        if len(row):
            target = base[own] + follower[row].astype(np.uint64)
            at = self.followers.successor(target, lo[own], hi[own])
            hit = (at < hi[own]) & (self.followers[np.minimum(at, self.followers.n - 1)] == target)
            out[row[hit]] = at[hit]
        return out

    def shares(self, place: np.ndarray) -> np.ndarray:
        """Codes of the followers' shares at their nodes, 65535 where unseen."""
        out = np.full(len(place), 65535, np.uint16)
        out[place >= 0] = self.share[place[place >= 0]]
        return out

    def left(self, node: np.ndarray) -> np.ndarray:
        """Codes of what each node leaves to the lower order: all of it where it is unknown."""
        out = np.zeros(len(node), np.uint16)
        out[node >= 0] = self.rest[node[node >= 0]]
        return out


NAME_BITS = 40


class NgramTrie:
    """Words, below each word the words that follow it, below each of these pairs what follows it, and so on.

    words: hashes of the first words, ascending. counts: the running sum of
    their counts. names: the first NAME_BITS bits of the hashes of words that
    follow, ascending: two followers of one context are told apart by these.
    levels: one for each order from 2.
    """

    def __init__(self, words: EliasFano, counts: EliasFano, names: EliasFano, levels: list[Level]) -> None:
        self.words, self.counts, self.names, self.levels = words, counts, names, levels

    @classmethod
    def build(cls, words: np.ndarray, counts: np.ndarray, names: np.ndarray, levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> NgramTrie:
        """words (ascending hashes) with counts (0 allowed), and names, ascending; for each level its nodes as (node above, name's number, times), ascending."""
        made, nodes = [], len(words)
        for node, follower, times in levels:
            made.append(Level.build(nodes, node, follower, times))
            nodes = len(node)
        return cls(EliasFano.encode(words, 1 << 64), EliasFano.encode(np.concatenate([[0], np.cumsum(counts)]), int(counts.sum()) + 1), EliasFano.encode(names, 1 << NAME_BITS), made)

    @staticmethod
    def _places(of: EliasFano, values: np.ndarray) -> np.ndarray:
        if not of.n or not len(values):
            return np.full(len(values), -1)
        at = of.successor(values, np.zeros(len(values), np.int64), np.full(len(values), of.n))
        return np.where((at < of.n) & (of[np.minimum(at, of.n - 1)] == values), at, -1)

    def number(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of words by their hashes, -1 for unknown ones."""
        return self._places(self.words, hashes)

    def name(self, names: np.ndarray) -> np.ndarray:
        """Numbers of names, -1 for unknown ones."""
        return self._places(self.names, names)

    def count(self, number: np.ndarray) -> np.ndarray:
        k = np.maximum(number, 0)
        got = (self.counts[k + 1] - self.counts[k]).astype(np.int64) if self.words.n else np.zeros(len(k), np.int64)
        return np.where(number >= 0, got, 0)

    def _arrays(self) -> dict[str, np.ndarray]:
        sequences = {"words": self.words, "counts": self.counts, "names": self.names}
        out = {}
        for k, v in enumerate(self.levels):
            sequences |= {f"{k}.first": v.first, f"{k}.followers": v.followers}
            out |= {f"{k}.share": v.share, f"{k}.rest": v.rest}
        return out | {f"{k}.{p}": a for k, v in sequences.items() for p, a in v.parts().items()}

    def dump(self) -> bytes:
        head, at, body = {}, 0, []
        for k, v in self._arrays().items():
            raw = np.ascontiguousarray(v).tobytes()
            head[k] = [v.dtype.str, len(v), at]
            raw += bytes(-len(raw) % 8)
            body.append(raw)
            at += len(raw)
        text = json.dumps({"levels": len(self.levels), "arrays": head}).encode()
        text += b" " * (-(len(text) + 8) % 8)
        return len(text).to_bytes(8, "little") + text + b"".join(body)

    @classmethod
    def load(cls, buffer) -> NgramTrie:
        """A trie over a buffer, such as a mapped file; nothing is copied."""
        size = int.from_bytes(bytes(buffer[:8]), "little")
        head = json.loads(bytes(buffer[8 : 8 + size]))
        arrays = {k: np.frombuffer(buffer, np.dtype(t), n, 8 + size + at) for k, (t, n, at) in head["arrays"].items()}

        def sequence(name: str) -> EliasFano:
            return EliasFano.of({p: arrays[f"{name}.{p}"] for p in ("head", "low", "high", "ones")})

        levels = [Level(sequence(f"{k}.first"), sequence(f"{k}.followers"), arrays[f"{k}.share"], arrays[f"{k}.rest"]) for k in range(head["levels"])]
        return cls(sequence("words"), sequence("counts"), sequence("names"), levels)
