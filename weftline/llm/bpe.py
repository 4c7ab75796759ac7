"""Public tokenizers over whole slices of text: the library sees each distinct word once.

Where a vocabulary's own rules make a word (a run without ASCII white space)
independent of its neighbours, results are kept by the word's 64-bit hash in a
table of bounded size and looked up by arrays. Whether they do is read from the
vocabulary's file: one with other rules, or of another library, encodes whole
texts by its library.
"""

from __future__ import annotations

import base64
import json
import re
from collections.abc import Iterator
import unicodedata

import numpy as np
import regex

from .textkern import NON_SPACE, HashTable, Slice, spread

_PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: Up to here lower-casing and composition don't depend on neighbours or on a library's Unicode version.
_PLAIN = re.compile(r"[\x21-\x7e¡-įı-ɏ]*\Z")


def byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte that byte-level vocabularies are written in."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


_LETTER = {b: s for b, s in byte_letters().items()}


def as_letters(piece: str) -> str:
    return piece.encode("utf-8").decode("latin-1").translate(_LETTER)


def load(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


#: The rules, as a tokenizers file states them, that the code in this subpackage follows.
_WORDS_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
WORD_RULES = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [{"type": "Split", "pattern": {"Regex": _WORDS_PATTERN}, "behavior": "Removed", "invert": True}, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}],
    },
}
BYTE_RULES = {"normalizer": None, "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}}


def follows(path: str, rules: dict) -> bool:
    """Whether the vocabulary of a tokenizers file is a plain BPE model with these rules, and its added tokens are plain strings."""
    if not path.endswith(".json"):
        return False
    with open(path, encoding="utf-8") as f:
        own = json.load(f)
    model = own["model"]
    plain = model.get("type", "BPE") == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges"))
    strings = not any(t[k] for t in own.get("added_tokens") or [] for k in ("single_word", "lstrip", "rstrip", "normalized"))
    return plain and strings and not own.get("truncation") and not own.get("padding") and all(own.get(k) == v for k, v in rules.items())


class Library:
    """Whole texts by the library of a vocabulary's file: tokenizers (.json), sentencepiece (.model) or tiktoken (.tiktoken).

    top: the largest id. A tiktoken file holds ranks alone; its pattern comes with the public_tokenizers package.
    """

    def __init__(self, path: str) -> None:
        if path.endswith(".model"):
            import sentencepiece

            lib = sentencepiece.SentencePieceProcessor(model_file=path)
            self.top, self.encode = lib.get_piece_size() - 1, lambda texts: lib.encode(texts, num_threads=1)
        elif path.endswith(".tiktoken"):
            import public_tokenizers
            import tiktoken

            with open(path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
            self.top, self.encode = max(ranks.values()), lambda texts: [own.encode_ordinary(t) for t in texts]
        else:
            json_lib = load(path)
            json_lib.no_truncation()
            json_lib.no_padding()
            self.top = max(json_lib.get_vocab(with_added_tokens=True).values())
            self.encode = lambda texts: [e.ids for e in json_lib.encode_batch(texts, add_special_tokens=False)]

    def of_slice(self, s: Slice) -> Iterator[list[int]]:
        """The ids of each row."""
        raw = s.blob.tobytes()
        for lo in range(0, len(s), 256):
            yield from self.encode([raw[a:e].decode("utf-8", "replace") for a, e in zip(s.starts[lo : lo + 256].tolist(), s.ends[lo : lo + 256].tolist())])


def id_width(path: str, *ids: int) -> int:
    """Bytes of an unsigned id (2 or 4) that hold every id of a vocabulary, and ids."""
    return 2 if max(Library(path).top, *ids, 0) < 1 << 16 else 4


class WordEncoder:
    """Token ids of texts: word by word for vocabularies that follow WORD_RULES, else text by text."""

    KEEP = 1 << 19

    def __init__(self, path: str) -> None:
        self.dtype = np.uint16 if id_width(path) == 2 else np.uint32
        self.whole = None if follows(path, WORD_RULES) else Library(path)
        if self.whole is None:
            self.lib = load(path)
            self.specials = [t.content for t in self.lib.get_added_tokens_decoder().values()]
            self.clear()

    def clear(self) -> None:
        self.table = HashTable(20)
        self.pieces: dict[str, list[int]] = {}
        self.at = np.zeros(1 << 16, np.int64)
        self.n = np.zeros(1 << 16, np.int64)
        self.words = 0
        self.pool = np.zeros(1 << 18, self.dtype)
        self.used = 0

    def _encode(self, word: str) -> list[int]:
        if not _PLAIN.match(word) or "<" in word and any(s in word for s in self.specials):
            return self.lib.encode(word, add_special_tokens=False).ids
        low = (word if word.isascii() else unicodedata.normalize("NFC", word)).lower()
        if low.isalpha():  # most words need no pattern
            found = (low,)
        elif low[-1] in ".," and low[:-1].isalpha():
            found = (low[:-1], low[-1])
        else:
            found = _PIECE.findall(low)
        out: list[int] = []
        for piece in found:
            ids = self.pieces.get(piece)
            if ids is None:
                ids = self.pieces[piece] = [t.id for t in self.lib.model.tokenize(as_letters(piece))]
            out += ids
        return out

    def _learn(self, s: Slice, h: np.ndarray, at: np.ndarray, end: np.ndarray) -> None:
        new, first = np.unique(h, return_index=True)
        if self.table.size + len(new) > min(self.KEEP, self.table.limit):
            self.clear()
        while self.table.limit < len(new):
            self.table = HashTable(self.table.bits + 1)
        raw = s.blob.tobytes()
        lists = [self._encode(raw[a:e].decode("utf-8", "replace")) for a, e in zip(at[first].tolist(), end[first].tolist())]
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        flat = np.fromiter((i for x in lists for i in x), self.dtype, int(sizes.sum()))
        while self.words + len(new) > len(self.at):
            self.at, self.n = (np.concatenate([x, np.zeros_like(x)]) for x in (self.at, self.n))
        while self.used + len(flat) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        own = slice(self.words, self.words + len(new))
        self.at[own] = self.used + np.cumsum(sizes) - sizes
        self.n[own] = sizes
        self.pool[self.used : self.used + len(flat)] = flat
        self.table.put(new, np.arange(own.start, own.stop))
        self.words += len(new)
        self.used += len(flat)

    def encode(self, s: Slice) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the slice's rows, one after another, and the number of ids of each row."""
        if self.whole is not None:
            lists = list(self.whole.of_slice(s))
            sizes = np.fromiter(map(len, lists), np.int64, len(lists))
            return np.fromiter((i for x in lists for i in x), self.dtype, int(sizes.sum())), sizes
        at, end, doc = s.words(NON_SPACE)
        h = s.hashes(at, end, fold=False)
        got = self.table.get(h)
        missing = np.flatnonzero(got < 0)
        if len(missing):
            before = self.table
            self._learn(s, h[missing], at[missing], end[missing])
            if self.table is before and self.table.size:
                got[missing] = self.table.get(h[missing])
            if self.table is not before or (got < 0).any():  # it began anew: the rest is learnt too
                got = self.table.get(h)
                if len(missing := np.flatnonzero(got < 0)):
                    keep = self.KEEP
                    self.KEEP = 1 << 62
                    self._learn(s, h[missing], at[missing], end[missing])
                    self.KEEP = keep
                    got = self.table.get(h)
        n = self.n[got]
        per_row = np.bincount(doc, weights=n, minlength=len(s)).astype(np.int64)
        return self.pool[spread(self.at[got], n)], per_row
