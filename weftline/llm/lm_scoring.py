"""Language-model scores from an Elias-Fano n-gram trie that is built, and asked, in shards.

Model: n-grams (3 words unless told otherwise) with Witten-Bell smoothing at
each order, over add-one unigrams. A document starts after a start mark and
ends with an end token; its first words have shorter contexts.

1. Each block of documents (a slice of some MB) makes its dictionary of words,
   of word pairs, of triples, with their counts in training documents. What
   belongs to one shard, by the hash of the first word, leaves as one
   compressed row; words that follow are numbers in a dictionary of the row.
2. A shard adds up its blocks' counts, builds its trie, writes it as a file in
   the shared folder, maps the file, and answers each block's words and n-grams.
   A word that a third of all rows hold is one entry for each block.
3. A block's answers meet its token numbers again, and give its scores.

A context word that many pairs share (found in a sample, which decides on
nothing else) is split by its followers' hashes into several contexts of other
shards; their sums, added up by the block, are the whole context's, and longer
contexts lie whole in the part of their second word. So no task holds more than
a block or a shard, and what moves is in proportion to the corpus. A block
sends at most one row for each shard, and for each of its distinct words. A
longer context isn't split: if one pair of words had most of all followers, its
shard would hold one entry for each kind of follower and block. Words are known
by 64-bit hashes, and among the followers of one context by 40 bits of these.

Nulls and empties: a null text is an empty one and scores its end token alone;
a null doc_id is carried along and counts as the text '' in the split; repeated
rows are scored each. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .elias_fano import NAME_BITS, NgramTrie, dequantise
from .runtime import Scratch, exact_keys, quoted
from .textkern import NON_SPACE, Slice, mix, slices
from .token_output import IdFile, _open

START, END = np.uint64(1), np.uint64(2)
BLOCK_BYTES = 6 << 20
#: Bytes of the sample in which common contexts are looked for, and the least share of all pairs that makes one common.
SAMPLE_BYTES, LEAST_SHARE = 64 << 20, 2.0**-16
_CUT = np.uint64(64 - NAME_BITS)
_PART, _FOLLOWER = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)

#: Hashes of common contexts, ascending, and the number of parts of each.
Common = tuple[np.ndarray, np.ndarray]


class Block:
    """The words and n-grams of a slice of documents, in an order of their own.

    words: hashes by shard, then by value; split marks those that are parts of
    common contexts. token: each token's number in words. levels: the distinct
    n-grams of each order from 2 (see ngrams), so a shard's contexts, and its
    n-grams, lie side by side; bounds: where each shard begins, in words and in
    each level. whole, parts: numbers of the common contexts here, and of their
    parts, one context after another. chosen: for each token after a common
    context, which part it belongs to.
    """

    def __init__(self, s: Slice, shards: int, common: Common, order: int) -> None:
        at, end, doc = s.words(NON_SPACE)
        edge = np.searchsorted(doc, np.arange(len(s) + 1))
        hashes = np.insert(s.hashes(at, end), edge[1:], END)
        self.sizes = np.diff(edge) + 1
        before = np.concatenate([[START], hashes[:-1]])
        before[np.cumsum(self.sizes)[:-1]] = START
        plain, back = np.unique(np.append(hashes, START), return_inverse=True)
        k = np.flatnonzero(np.isin(common[0], plain))
        names, self.width = common[0][k], common[1][k]
        first = np.cumsum(self.width) - self.width
        owner = np.repeat(np.arange(len(k)), self.width)
        parts = mix(names[owner] + (np.arange(len(owner)) - first[owner] + 1).astype(np.uint64) * _PART)
        distinct = np.concatenate([plain, parts])
        shard = (mix(distinct) % np.uint64(shards)).astype(np.int64)
        sort = np.lexsort((distinct, shard))
        rank = np.empty(len(sort), np.int64)
        rank[sort] = np.arange(len(sort))
        self.words = distinct[sort]
        self.bounds = [np.searchsorted(shard[sort], np.arange(shards + 1))]
        numbers = rank[back]
        self.token, self.start, self.whole, self.parts = numbers[:-1], numbers[-1], rank[np.searchsorted(plain, names)], rank[len(plain) :]
        self.split = np.zeros(len(self.words), np.uint8)
        self.split[self.parts] = 1
        self.chosen = np.zeros(0, np.uint16)
        if len(k):
            place = np.minimum(np.searchsorted(names, before), len(names) - 1)
            hot = names[place] == before
            self.chosen = (mix(hashes[hot] ^ _FOLLOWER) % self.width[place[hot]].astype(np.uint64)).astype(np.uint16)
        context = contexts(self.token, self.sizes, self.start, self.whole, self.width, self.parts, self.chosen)
        self.levels = ngrams(self.token, self.sizes, context, len(self.words), order)
        for keys, _, _ in self.levels:
            self.bounds.append(np.searchsorted(keys, self.bounds[-1] * len(self.words)))
        self.check = int(np.bitwise_xor.reduce(mix(self.words + np.uint64(len(self.words)))) >> np.uint64(1))


def contexts(token: np.ndarray, sizes: np.ndarray, start: int, whole: np.ndarray, width: np.ndarray, parts: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """The number of each token's context: the word before it, or its part of a common one."""
    out = np.concatenate([[start], token[:-1]])
    out[np.cumsum(sizes)[:-1]] = start
    if len(whole):
        first = np.cumsum(width) - width
        order = np.argsort(whole)
        place = order[np.minimum(np.searchsorted(whole[order], out), len(whole) - 1)]
        hot = np.flatnonzero(whole[place] == out)
        out[hot] = parts[first[place[hot]] + chosen]
    return out


def ngrams(token: np.ndarray, sizes: np.ndarray, context: np.ndarray, words: int, order: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each order from 2: the distinct n-grams, the tokens that end one, and each such token's n-gram.

    An n-gram is its context's place in the order below (for pairs, a word's
    number) * words + the last word's number; they ascend. The first tokens of
    a document end no long n-gram: the second one's triple begins with the start.
    """
    since = np.arange(len(token)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out, above = [], context
    for k in range(order - 1):
        rows = np.flatnonzero(since >= k)
        keys, back = np.unique(above[rows] * words + token[rows], return_inverse=True)
        out.append((keys, rows, back))
        above = np.zeros(len(token), np.int64)
        above[rows[rows + 1 < len(token)] + 1] = back[rows + 1 < len(token)]
    return out


def common_contexts(rows: DataFrame, size: int, shards: int) -> Common:
    """Contexts with over half a shard's share of the pairs of a sample, and into how many parts each goes."""
    least = max(0.5 / shards, LEAST_SHARE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in slices(batch.column(2), BLOCK_BYTES):
                b = Block(s, 1, (np.zeros(0, np.uint64), np.zeros(0, np.int64)), 2)
                pair = b.levels[0][0]
                n = np.bincount(pair // len(b.words), minlength=len(b.words))
                top = np.flatnonzero(n > least / 8 * len(pair))
                yield pa.record_batch([pa.array([0, *b.words[top].view(np.int64).tolist()], pa.int64()), pa.array([len(pair), *n[top].tolist()], pa.int64())], names=["word", "n"])

    part = rows if size <= SAMPLE_BYTES else rows.sample(SAMPLE_BYTES / size, 42)
    found = part.mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    total = found.filter("word = 0").first()
    if total is None or not total.n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    top = found.filter((F.col("word") != 0) & (F.col("n") > least * total.n)).collect()  # 1 / least rows at most
    names = np.array([r.word for r in top], np.int64).view(np.uint64)
    order = np.argsort(names)
    share = np.array([r.n / total.n for r in top])
    return names[order], np.minimum(np.ceil(share * shards * 2).astype(np.int64) + 1, 65_535)[order]


def _squeeze(*arrays: np.ndarray) -> bytes:
    head = np.array([len(a) for a in arrays], np.int64).tobytes()
    raw = head + b"".join(a.tobytes() for a in arrays)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _expand(blob: bytes, *kinds: type) -> list[np.ndarray]:
    raw = pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), codec="zstd", asbytes=True)
    sizes, at, out = np.frombuffer(raw, np.int64, len(kinds)), 8 * len(kinds), []
    for n, kind in zip(sizes.tolist(), kinds):
        out.append(np.frombuffer(raw, kind, n, at))
        at += out[-1].nbytes
    return out


def _halves(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers as low and high 16 bits: the high ones, mostly equal, compress to nearly nothing."""
    return (x & 0xFFFF).astype(np.uint16), (x >> 16).astype(np.uint16)


def _joined(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return low.astype(np.int64) | high.astype(np.int64) << 16


def _steps(ascending: np.ndarray, width: int) -> np.ndarray:
    """Ascending integers of width bytes as steps from one to the next, all first bytes before all second ones: the high bytes are mostly 0."""
    return np.ascontiguousarray(np.diff(ascending, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8)[:, :width].T).ravel()


def _summed(steps: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros((len(steps) // width, 8), np.uint8)
    out[:, :width] = steps.reshape(width, -1).T
    return np.cumsum(out.view(np.uint64).ravel(), dtype=np.uint64)


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Slice, pa.RecordBatch]]:
    """Blocks of about BLOCK_BYTES of text: small batches together, large ones cut."""
    from pyspark import TaskContext

    block = TaskContext.get().partitionId() << 32

    def together(held: list[pa.RecordBatch]) -> Iterator[tuple[Slice, pa.RecordBatch]]:
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()
        for batch in rows:
            for s in slices(batch.column(2), BLOCK_BYTES):
                yield s, batch.slice(s.first, len(s))

    held, size = [], 0
    for batch in batches:
        own = batch.column(2).nbytes
        if held and size + own > BLOCK_BYTES:
            for s, rows in together(held):
                yield block, s, rows
                block += 1
            held, size = [], 0
        held.append(batch)
        size += own
    if held:
        for s, rows in together(held):
            yield block, s, rows
            block += 1


def _message(b: Block, k: int, count: np.ndarray, times: list[np.ndarray]) -> bytes:
    """What a block tells and asks shard k: its words there and their counts; for each order how many n-grams each context has, their last words by the row's own dictionary, and their counts."""
    own = [slice(x[k], x[k + 1]) for x in b.bounds]
    last = [keys[s] % len(b.words) for (keys, _, _), s in zip(b.levels, own[1:])]
    place = np.zeros(len(b.words), np.int64)
    for x in last:
        place[x] = 1
    names = np.flatnonzero(place)
    values, place[names] = np.unique(b.words[names] >> _CUT, return_inverse=True)
    out = [_steps(b.words[own[0]], 8), count[own[0]], b.split[own[0]], _steps(values, NAME_BITS // 8)]
    for (keys, _, _), x, n, above, s in zip(b.levels, last, times, own, own[1:]):
        width = np.bincount(keys[s] // len(b.words) - above.start, minlength=above.stop - above.start)
        out += [width.astype(np.uint32), *_halves(place[x]), n[s]]
    return _squeeze(*out)


#: Types of a message's arrays, and of those that it has for each order.
_HEAD, _EACH = (np.uint8, np.uint32, np.uint8, np.uint8), (np.uint32, np.uint16, np.uint16, np.uint32)


class Asked:
    """A message, read: words, count, split, names, and for each order (width, last, times)."""

    def __init__(self, data: bytes, order: int) -> None:
        words, self.count, self.split, names, *rest = _expand(data, *_HEAD, *_EACH * (order - 1))
        self.words, self.names = _summed(words, 8), _summed(names, NAME_BITS // 8)
        self.levels = [(rest[k], _joined(rest[k + 1], rest[k + 2]).astype(np.uint32), rest[k + 3]) for k in range(0, len(rest), 4)]


def _questions(docs: DataFrame, shards: int, common: Common, keys: np.ndarray, order: int) -> DataFrame:
    """A row for each block and shard with what the block holds of it. key sends each shard to a task of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, s, rows in _numbered(batches):
            b = Block(s, shards, common, order)
            learn = np.repeat(rows.column(1).to_numpy(zero_copy_only=False).astype(bool), b.sizes)
            count = np.bincount(b.token[learn], minlength=len(b.words)).astype(np.uint32)
            times = [np.bincount(back[learn[own]], minlength=len(grams)).astype(np.uint32) for grams, own, back in b.levels]
            full = np.flatnonzero(np.diff(b.bounds[0])).tolist()
            out = [_message(b, k, count, times) for k in full]
            yield pa.record_batch(
                [pa.array(full, pa.int32()), pa.array([block] * len(full), pa.int64()), pa.array([b.check] * len(full), pa.int64()), pa.array(out, pa.binary()), pa.array(keys[full], pa.int32())],
                names=["shard", "block", "check", "data", "key"],
            )

    return docs.mapInArrow(run, "shard int, block long, check long, data binary, key int")


def train_shard(asked: list[Asked], order: int) -> NgramTrie:
    """The trie of the training counts of a shard's blocks; the count of a part of a context is that of its pairs."""
    known, follow = [], []
    for a in asked:
        width, _, times = a.levels[0]
        seen = a.count > 0
        seen[np.repeat(np.arange(len(a.words)), width)[times > 0]] = True
        known.append(a.words[seen])
        seen = np.zeros(len(a.names), bool)
        for _, last, times in a.levels:
            seen[last[times > 0]] = True
        follow.append(a.names[seen])
    words, names = np.unique(np.concatenate(known)), np.unique(np.concatenate(follow))
    n = max(1, len(names))
    total = np.zeros(len(words), np.int64)
    own = [np.searchsorted(words, a.words) for a in asked]
    lasts = [np.searchsorted(names, a.names) for a in asked]
    for a, w in zip(asked, own):
        some = a.count > 0
        total[w[some]] += a.count[some]
    levels, above = [], own
    for k in range(order - 1):
        keys, times, split, seen = [], [], [], []
        for a, nodes, place in zip(asked, above, lasts):
            width, last, t = a.levels[k]
            live = np.flatnonzero(t)
            context = np.repeat(np.arange(len(nodes)), width)[live]
            keys.append(nodes[context] * n + place[last[live]])
            times.append(t[live].astype(np.int64))
            seen.append(live)
            split.append(a.split[context] > 0 if k == 0 else np.zeros(0, bool))
        grams, back = np.unique(np.concatenate(keys), return_inverse=True)
        every = np.concatenate(times)
        node, follower = grams // n, grams % n
        if k == 0:
            parts = np.concatenate(split)
            total += np.bincount(np.concatenate(keys)[parts] // n, weights=every[parts], minlength=len(total)).astype(np.int64)
        levels.append((node, follower, np.bincount(back, weights=every, minlength=len(grams)).astype(np.int64)))
        nodes, at = [], 0
        for a, live in zip(asked, seen):
            place = np.zeros(len(a.levels[k][1]), np.int64)
            place[live] = back[at : at + len(live)]
            nodes.append(place)
            at += len(live)
        above = nodes
    return NgramTrie.build(words, total, names, levels)


def _answers(questions: DataFrame, folder: str, shards: int, order: int, keep_model: bool) -> DataFrame:
    """Asked rows with the shard's answers; and a row for each shard: vocabulary and tokens of training."""
    names = ["shard", "block", "check", "data", "kinds", "tokens"]
    types = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]

    def row(*values) -> pa.RecordBatch:
        return pa.record_batch([pa.array([v], t) for v, t in zip(values, types)], names=names)

    def shard_rows(shard: int, blocks: list[int], checks: list[int], data: list[bytes]) -> Iterator[pa.RecordBatch]:
        import uuid

        asked = [Asked(d, order) for d in data]
        trie = train_shard(asked, order)
        where, root = _open(folder)
        where.create_dir(root, recursive=True)
        path = f"{root}/shard-{shard:06d}-{uuid.uuid4().hex[:12]}.trie"
        with where.open_output_stream(path) as f:
            f.write(trie.dump())
        trie = NgramTrie.load(IdFile._map(where, path))
        known = trie.count(np.arange(trie.words.n))
        divided = trie.number(np.unique(np.concatenate([a.words[a.split > 0] for a in asked])))
        known[divided[divided >= 0]] = 0
        yield row(shard, -1, 0, None, int((known > 0).sum()), int(known.sum()))
        del asked
        for block, check, d in zip(blocks, checks, data):
            a = Asked(d, order)
            number, last = trie.number(a.words), trie.name(a.names)
            out, node = [trie.count(number), trie.levels[0].kinds(number[a.split > 0])], number
            for level, (width, follower, _) in zip(trie.levels, a.levels):
                place = level.find(node, width, last[follower])
                out += [level.left(node), level.shares(place)]
                node = place
            yield row(shard, block, check, _squeeze(*out), 0, 0)
        if not keep_model:
            where.delete_file(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, own = None, ([], [], [])
        for batch in batches:
            for shard, *values in zip(*(c.to_pylist() for c in batch.columns)):
                if shard != now:
                    if now is not None:
                        yield from shard_rows(now, *own)
                    now, own = shard, ([], [], [])
                for column, v in zip(own, values):
                    column.append(v)
        if now is not None:
            yield from shard_rows(now, *own)

    placed = questions.repartition(shards, "key").sortWithinPartitions("shard", "block").drop("key")
    return placed.mapInArrow(run, "shard int, block long, check long, data binary, kinds long, tokens long")


def _tokens(docs: DataFrame, shards: int, common: Common) -> DataFrame:
    """A row for each block: what it needs of itself when the answers come."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, s, rows in _numbered(batches):
            b = Block(s, shards, common, 1)
            ids = rows.column(0).to_pylist()
            data = _squeeze(*_halves(b.token), *(x.astype(np.uint32) for x in (b.sizes, b.bounds[0], np.array([b.start]), b.whole, b.width, b.parts, b.chosen)))
            yield pa.record_batch(
                [pa.array([block], pa.int64()), pa.array([-1], pa.int32()), pa.array([b.check], pa.int64()), pa.array([data], pa.binary()), pa.array([ids], pa.list_(pa.int64())), pa.array([rows.column(1).to_pylist()], pa.list_(pa.bool_()))],
                names=["block", "shard", "check", "data", "ids", "learn"],
            )

    return docs.mapInArrow(run, "block long, shard int, check long, data binary, ids array<long>, learn array<boolean>")


def _scores(tokens: DataFrame, answers: DataFrame, parts: int, vocabulary: int, total: int, order: int) -> DataFrame:
    def score(head: dict, got: dict[int, bytes]) -> pa.RecordBatch:
        low, high, *rest = _expand(head["data"], np.uint16, np.uint16, *[np.uint32] * 7)
        token = _joined(low, high)
        sizes, bounds, start, whole, width, parts, chosen = (x.astype(np.int64) for x in rest)
        if set(got) != set(np.flatnonzero(np.diff(bounds)).tolist()):
            raise RuntimeError("a block met the answers of another one: the input changed while it was read")
        answer = [_expand(got[k], np.int64, np.int64, *[np.uint16] * (2 * order - 2)) for k in sorted(got)]
        count, kinds, *codes = (np.concatenate(x) for x in zip(*answer))
        context = contexts(token, sizes, start[0], whole, width, parts, chosen)
        base = (count + 1.0) / (total + vocabulary + 1.0)
        scale, rest = np.ones(len(count)), dequantise(codes[0])
        if len(parts):
            # The parts' sums are those of the whole context. kinds holds the parts in order of their numbers.
            own = np.empty(len(parts), np.int64)
            own[np.argsort(parts)] = kinds
            group = np.repeat(np.arange(len(whole)), width)
            mass, every = count[parts] + own, np.bincount(group, weights=count[parts] + own, minlength=len(whole))
            scale[parts] = mass / np.maximum(every[group], 1)
            rest[parts] = np.where(every > 0, np.bincount(group, weights=own, minlength=len(whole)) / np.maximum(every, 1), 1.0)[group]
        p, above = base[token], context
        for k, (_, rows, back) in enumerate(ngrams(token, sizes, context, len(count), order)):
            share = dequantise(codes[2 * k + 1])[back]
            if k:
                p[rows] = share + dequantise(codes[2 * k])[above[rows]] * p[rows]
            else:
                p = share * scale[context] + rest[context] * p
            above = np.zeros(len(token), np.int64)
            above[rows[rows + 1 < len(token)] + 1] = back[rows + 1 < len(token)]
        row = np.repeat(np.arange(len(sizes)), sizes)
        add = lambda w: np.bincount(row, weights=w, minlength=len(sizes))
        return pa.record_batch(
            [
                pa.array(head["ids"], pa.int64()),
                pa.array([not x for x in head["learn"]]),
                pa.array(sizes),
                pa.array(add(count[token] > 0).astype(np.int64)),
                pa.array(np.full(len(sizes), total, np.int64)),
                pa.array(add(np.log10(base[token]))),
                pa.array(np.minimum(add(np.log10(p)), 0.0)),
            ],
            names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, got = None, {}
        for batch in batches:
            for r in batch.to_pylist():
                if r["shard"] < 0:
                    if head is not None:
                        yield score(head, got)
                    head, got = r, {}
                elif head is None or (r["block"], r["check"]) != (head["block"], head["check"]):
                    raise RuntimeError("a block met the answers of another one: the input changed while it was read")
                else:
                    got[r["shard"]] = r["data"]
        if head is not None:
            yield score(head, got)

    both = tokens.unionByName(answers.filter("block >= 0").select("block", "shard", "check", "data"), allowMissingColumns=True)
    ordered = both.repartition(parts, "block").sortWithinPartitions("block", "shard")
    return ordered.mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def score(docs: DataFrame, learn: Column, shard_bytes: int = 12 << 20, order: int = 3, keep_model: bool = True, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, str]:
    """Scores of each row of docs under the model of the rows where learn holds, and the folder of the model's tries.

    shard_bytes: text for each shard; a shard is what one task holds. order:
    words in the longest n-grams, 2 or more. keep_model: whether the tries stay
    in the folder; else each goes when its shard has answered every block.
    """
    if order < 2:
        raise ValueError("order must be 2 or more")
    scratch = Scratch(docs.sparkSession)
    rows = docs.select(F.col(quoted(id_col)).cast("long").alias("doc_id"), F.coalesce(learn, F.lit(True)).alias("learn"), F.col(quoted(text_col)).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(12, -(-size // shard_bytes))
    folder = scratch.path("model")
    common = common_contexts(rows, size, shards)
    answers = scratch.table(_answers(_questions(rows, shards, common, exact_keys(docs.sparkSession, shards), order), folder, shards, order, keep_model), "answers")
    sums = answers.filter("block < 0").agg(F.sum("kinds"), F.sum("tokens")).first()
    parts = max(12, -(-size // (2 * BLOCK_BYTES)))
    return _scores(_tokens(rows, shards, common), answers, parts, int(sums[0] or 0), int(sums[1] or 0), order), folder
