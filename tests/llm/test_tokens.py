"""Token counts, packing and id files against the tokenizers library."""

import numpy as np
import pyarrow as pa
import pytest
from conftest_llm import crc, path

from weftline.llm.bpe import Library, WordEncoder, load
from weftline.llm.packing import pack, windows
from weftline.llm.textkern import NON_SPACE, HashTable, mix, slices, spread
from weftline.llm.token_counts import count_tokens, squeeze, unsqueeze
from weftline.llm.token_output import export_ids, read_ids

TEXTS = ["", None, "Hello World!! it's 1234 <|endoftext|>x foo<|startoftext|>", "ΑΣ ΣΑΣ ÉÈ é ́a İstanbul ﬁ \x1cb\x1d", "a b　c Ǆ ǅ ß ẞ", " ", "\n \n", "tail  ", "x   y\x1c z", "<|endoftext|>", "don't I'LL 12ab"] * 2


def key(r):
    return (r[0] is None, r[0] or 0, r)


@pytest.mark.parametrize("limit", [10, 60, 1 << 20])
def test_words_equal_the_library(limit):
    words = WordEncoder(path("word_bpe_49k.json"))
    for s in slices(pa.array(TEXTS), limit):
        ids, n = words.encode(s)
        at = 0
        for k in range(len(s)):
            text = TEXTS[s.first + k] or ""
            assert ids[at : at + n[k]].tolist() == words.lib.encode(text, add_special_tokens=False).ids
            at += n[k]


def test_encoder_starts_anew_when_full():
    words = WordEncoder(path("word_bpe_49k.json"))
    words.KEEP = 3
    for s in slices(pa.array(["a b c d e f", "c d g h", "a a a"]), 4):
        ids, n = words.encode(s)
        want = [i for k in range(len(s)) for i in words.lib.encode(["a b c d e f", "c d g h", "a a a"][s.first + k], add_special_tokens=False).ids]
        assert ids.tolist() == want


def test_kernel_helpers():
    table, h = HashTable(12), mix(np.arange(1, 1001, dtype=np.uint64))
    table.put(h, np.arange(1000))
    assert (table.get(h) == np.arange(1000)).all() and (table.get(mix(h)) == -1).all()
    assert spread(np.array([5, 9, 2]), np.array([2, 0, 3])).tolist() == [5, 6, 2, 3, 4]
    s = next(slices(pa.array(["ab Cd  ab", None, "", "ab\nCD"])))
    at, end, row = s.words(NON_SPACE)
    assert row.tolist() == [0, 0, 0, 3, 3] and len(set(s.hashes(at, end).tolist())) == 2


@pytest.mark.parametrize("limit", [10, 60, 1 << 20])
def test_pieces_equal_the_library_in_blocks_of_any_size(spark, limit):
    lib = load(path("byte_bpe_50k.json"))
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").repartition(2)
    got = count_tokens(docs, path("byte_bpe_50k.json"), block_bytes=limit, buckets=7).collect()
    assert {r.doc_id: r.n_tokens for r in got} == {k: len(lib.encode(t or "", add_special_tokens=False).ids) for k, t in enumerate(TEXTS)}
    assert len(got) == len(TEXTS)


def test_pieces_of_a_real_table_and_a_very_long_word(spark, some):
    lib = load(path("byte_bpe_50k.json"))
    docs = some.select("doc_id", "text").unionByName(spark.createDataFrame([(-1, "xY9" * 300_000), (-2, "\n" * 300_000)], "doc_id long, text string"))
    want = {r.doc_id: len(lib.encode(r.text or "", add_special_tokens=False).ids) for r in docs.collect()}
    assert {r.doc_id: r.n_tokens for r in count_tokens(docs, path("byte_bpe_50k.json")).collect()} == want


def test_squeezed_integers_come_back():
    for a in ([], [0], [255, 256], [1 << 40, 3]):
        assert unsqueeze(squeeze(np.array(a, np.int64))).tolist() == a


def test_counts(odd, none):
    lib = load(path("byte_bpe_50k.json"))
    got = sorted(map(tuple, count_tokens(odd, path("byte_bpe_50k.json")).collect()), key=key)
    want = sorted(((r.doc_id, len((r.text or "").encode()), len(lib.encode(r.text or "", add_special_tokens=False).ids)) for r in odd.collect()), key=key)
    assert got == want
    assert count_tokens(none, path("byte_bpe_50k.json")).count() == 0


def test_pack_is_a_gapless_sequence(odd, none):
    lib = load(path("word_bpe_49k.json"))
    rows = pack(odd, path("word_bpe_49k.json"), window=64, end_id=2).collect()
    rows.sort(key=lambda r: (r.sequence_id, r.offset))
    at = 0
    for r in rows:
        assert r.sequence_id * 64 + r.offset == at and 0 < r.length <= 64 - r.offset
        at += r.length
    docs, open_ids = [], []
    for r in rows:  # pieces of one document follow each other
        ids = np.frombuffer(r.ids, "<u2").tolist()
        assert r.ids_crc32 == crc(ids) and r.start == len(open_ids)
        open_ids += ids
        if len(open_ids) == r.doc_tokens:
            docs.append((r.doc_id, open_ids))
            open_ids = []
    want = [(r.doc_id, [*lib.encode(r.text or "", add_special_tokens=False).ids, 2]) for r in odd.collect()]
    assert sorted(docs, key=key) == sorted(want, key=key)
    assert pack(none, path("word_bpe_49k.json")).count() == 0


def test_windows(odd):
    pieces = pack(odd, path("word_bpe_49k.json"), window=64, end_id=2)
    full = sorted(map(tuple, windows(pieces, 64, pad_id=7, pad_last_to_power_of_two=True).collect()))
    assert all(len(ids) == 64 for _, ids in full[:-1])
    n = pieces.agg({"length": "sum"}).first()[0]
    assert [len(ids) for _, ids in full][-1] in {1, 2, 4, 8, 16, 32, 64} and len(full) == -(-n // 64)


def test_id_files_round_trip(odd, none):
    lib = load(path("word_bpe_49k.json"))
    parts, folder = export_ids(odd, path("word_bpe_49k.json"), end_id=1, part_tokens=500)
    rows = sorted(read_ids(parts, folder).collect(), key=lambda r: r.start)
    at = 0
    for r in rows:
        assert r.start == at and r.ids_crc32 == crc(np.frombuffer(r.ids, "<u2"))
        at += r.n_tokens
    ids = [r.doc_id for r in rows]
    assert ids == sorted(ids, key=lambda x: (x is not None, x or 0))
    want = sorted(((r.doc_id, crc([*lib.encode(r.text or "", add_special_tokens=False).ids, 1])) for r in odd.collect()), key=key)
    assert sorted(((r.doc_id, r.ids_crc32) for r in rows), key=key) == want
    assert read_ids(*export_ids(none, path("word_bpe_49k.json"))).count() == 0


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken", "piece_bpe_32k.model", "word_bpe_49k.json"])
def test_every_vocabulary_equals_its_library(spark, some, odd, name):
    """Counts, packed and written ids of any file are its library's: rules in the code are used only for files that state them."""
    lib = Library(path(name))
    docs = odd.select("doc_id", "text").unionByName(some.select("doc_id", "text").limit(40)).unionByName(spark.createDataFrame([(1000, "Hello world, this is Big News")], "doc_id long, text string"))
    texts = [(r.doc_id, r.text or "") for r in docs.collect()]
    want = sorted((str(d), crc([*ids, 3]), len(ids) + 1) for (d, _), ids in zip(texts, lib.encode([t for _, t in texts])))
    counts = sorted((str(r.doc_id), r.n_tokens + 1) for r in count_tokens(docs, path(name), buckets=5).collect())
    assert counts == sorted((d, n) for d, _, n in want)
    written = read_ids(*export_ids(docs, path(name), end_id=3))
    assert sorted((str(r.doc_id), r.ids_crc32, r.n_tokens) for r in written.collect()) == want
    pieces = {}
    for r in pack(docs, path(name), window=1 << 20, end_id=3).collect():
        pieces.setdefault((str(r.doc_id), r.doc_tokens), []).append(r)
    assert sorted(k for k, rows in pieces.items() for r in rows if r.start == 0) == sorted((d, n) for d, _, n in want)


def test_changed_rules_go_to_the_library(tmp_path, spark):
    import json

    for name, key in (("word_bpe_49k.json", "normalizer"), ("byte_bpe_50k.json", "pre_tokenizer")):
        own = json.load(open(path(name)))
        if key == "normalizer":
            own[key]["normalizers"] = own[key]["normalizers"][:2]  # no lower-casing
        else:
            own[key]["add_prefix_space"] = True
        changed = str(tmp_path / name)
        json.dump(own, open(changed, "w"))
        docs = spark.createDataFrame([(1, "Hello World again"), (2, "x")], "doc_id long, text string")
        want = {d: len(ids) for d, ids in zip((1, 2), Library(changed).encode(["Hello World again", "x"]))}
        assert {r.doc_id: r.n_tokens for r in count_tokens(docs, changed).collect()} == want
        assert {r.doc_id: r.n_tokens - 1 for r in read_ids(*export_ids(docs, changed, end_id=1)).collect()} == want
