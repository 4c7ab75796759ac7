"""Columns that are called like the operators' own, very long texts, and vocabularies beyond 16 bits."""

import json

import numpy as np
import pytest
from conftest_llm import crc, path
from pyspark.sql import functions as F

from weftline.llm.bpe import load
from weftline.llm.decontaminate import digest, find, remove_hits
from weftline.llm.language_id import predict, prototypes
from weftline.llm.line_dedup import dedup_lines
from weftline.llm.lm_scoring import score
from weftline.llm.near_dedup import classes, keep_one
from weftline.llm.packing import pack, windows
from weftline.llm.quality import filter_documents, judge
from weftline.llm.sharding import shard_rows
from weftline.llm.token_counts import count_tokens
from weftline.llm.token_output import export_ids, read_ids

OWN = ["id", "h", "doc", "t", "gone", "all", "flags", "lines", "removed", "lang", "source", "n_words", "t_lang", "w", "l", "s", "runs", "key", "cell", "base", "size", "row", "hits", "items", "kept", "base_failed", "max_word_length"]
CLASH = [*(f"_wf_{c}" for c in OWN), "_WF_Doc_", "row", "u0", "t", "n", "a.b", "hits", "n_words", "items", "bands", "node"]


@pytest.fixture(scope="module")
def clash(spark):
    words = " ".join(f"word{k}" for k in range(60))
    rows = [(1, f"{words}\nthe same line of seven words here", "en", "a"), (2, f"{words} more\nthe same line of seven words here", "en", "a"), (3, None, None, None), (None, "", "en", "b")]
    return spark.createDataFrame([(*r, *(f"{c} {r[0]}" for c in CLASH)) for r in rows], "doc_id long, text string, lang string, source string, " + ", ".join(f"`{c}` string" for c in CLASH))


def extras(df, names):
    """The clashing columns by doc_id, taken by place: no operator may change them."""
    place = [names.index(c) for c in CLASH]
    return {r[0]: [r[k] for k in place] for r in df.collect()}


def test_columns_are_kept_whatever_their_names(clash, spark):
    want = extras(clash, clash.columns)
    n = len(clash.columns)
    items = spark.createDataFrame([(1, "word5 word6 word7")], "item_id long, text string")
    for out, added in ((dedup_lines(clash), 2), (judge(clash), 10), (find(clash, items, window=3), 3), (find(clash, items.union(items.selectExpr("2L", "'word8 word9 word10'")), window=3, block_bytes=1), 3)):
        assert out.columns[:n] == clash.columns and len({c.lower() for c in out.columns}) == len(out.columns) == n + added
        assert extras(out, out.columns[:n]) == want
    assert {r[0]: r[n + 1] for r in dedup_lines(clash).collect()} == {1: 0, 2: 2, 3: 0, None: 0}
    sharded = shard_rows(clash, 3, F.length("text"), F.col("text"), F.col("doc_id"))
    assert sharded.columns == [*clash.columns, "shard", "slot"] and extras(sharded, sharded.columns[:n]) == want
    assert extras(remove_hits(find(clash, items, window=3)), clash.columns) == want
    kept = extras(filter_documents(clash), clash.columns)
    assert kept == {k: v for k, v in want.items() if k in (1, 2)}
    one = extras(keep_one(clash), clash.columns)
    assert one == {k: v for k, v in want.items() if k != 2}
    assert digest(find(clash, items, window=3)).filter("contaminated").count() == 2


def test_operators_that_leave_columns_out(clash):
    assert count_tokens(clash, path("byte_bpe_50k.json")).count() == 4
    assert {r.doc_id for r in pack(clash, path("word_bpe_49k.json")).collect()} == {1, 2, 3, None}
    assert read_ids(*export_ids(clash, path("word_bpe_49k.json"))).count() == 4
    assert score(clash, F.lit(True))[0].count() == classes(clash).count() == 4
    assert predict(clash, *prototypes(clash)).count() == 4


def test_language_columns_with_dots_and_backticks(spark):
    rows = [(1, "the cat and the dog", "en"), (2, "der hund und die katze", "de"), (3, None, "en"), (4, "the house", None)]
    plain = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    odd = plain.toDF("a.id", "the`text", "lang.x")
    got = predict(odd, *prototypes(odd, text_col="the`text", lang_col="lang.x"), id_col="a.id", text_col="the`text")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, predict(plain, *prototypes(plain)).collect()))


def test_items_without_id_are_not_those_called_null(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    items = spark.createDataFrame([(None, "a b"), ("null", "b c")], "item_id string, text string")
    assert digest(find(docs, items)).first().n_items == 2


@pytest.fixture(scope="module")
def wide(tmp_path_factory):
    """A vocabulary whose ids lie beyond 16 bits: a public one's, moved up by 70,000."""
    table = json.load(open(path("word_bpe_49k.json")))
    table["model"]["vocab"] = {k: v + 70_000 for k, v in table["model"]["vocab"].items()}
    for token in table["added_tokens"]:
        token["id"] += 70_000
    table["post_processor"] = None
    out = tmp_path_factory.mktemp("wide") / "wide.json"
    out.write_text(json.dumps(table))
    return str(out)


def test_ids_beyond_16_bits(odd, wide):
    lib = load(wide)
    want = {str((r.doc_id, crc([*lib.encode(r.text or "", add_special_tokens=False).ids, 70_001]))) for r in odd.collect()}
    parts, folder = export_ids(odd, wide, end_id=70_001, part_tokens=500)
    assert {str((r.doc_id, r.ids_crc32)) for r in read_ids(parts, folder).collect()} == want
    pieces = pack(odd, wide, window=1 << 20, end_id=70_001)
    assert {str((r.doc_id, r.ids_crc32)) for r in pieces.collect()} == want
    ids = [i for r in windows(pieces, 1 << 20, pad_last_to_power_of_two=True).collect() for i in r.ids]
    assert ids.count(70_001) == odd.count()
    small = pack(odd, path("word_bpe_49k.json"), window=1 << 20, end_id=1 << 16)
    assert all(np.frombuffer(r.ids, "<u4")[-1] == 1 << 16 for r in small.collect())


def test_rows_of_one_id_are_written_to_several_parts(spark):
    docs = spark.range(3000).selectExpr("CAST(NULL AS LONG) AS doc_id", "concat('word', id) AS text").repartition(4)
    parts, folder = export_ids(docs, path("word_bpe_49k.json"), part_tokens=1000)
    sizes = [r.n_docs for r in parts.collect()]
    assert sum(sizes) == 3000 and max(sizes) < 1500
    assert read_ids(parts, folder).filter("doc_id IS NULL").count() == 3000


def test_very_long_texts_and_words(spark):
    rows = [(1, " ".join(f"w{k % 5000} is" for k in range(150_000))), (2, "x" * 1_000_000), (3, "\n".join(f"line {k} of very many lines here" for k in range(20_000))), (4, "short")]
    docs = spark.createDataFrame([(*r, "en", "s") for r in rows], "doc_id long, text string, lang string, source string")
    lib = load(path("word_bpe_49k.json"))
    got = {r.doc_id: r.n_tokens for r in read_ids(*export_ids(docs, path("word_bpe_49k.json"))).collect()}
    assert got == {d: len(lib.encode(t, add_special_tokens=False).ids) + 1 for d, t in rows}
    assert count_tokens(docs, path("byte_bpe_50k.json")).count() == score(docs, F.lit(True))[0].count() == predict(docs, *prototypes(docs)).count() == 4
    assert classes(docs).filter("kept").count() == 4 and dedup_lines(docs).count() == 4 and judge(docs).count() == 4
    assert find(docs, spark.createDataFrame([(1, "line 7 of very")], "item_id long, text string")).filter("_wf_hits IS NOT NULL").count() == 1
    assert shard_rows(docs, 2, F.length("text"), F.col("text"), F.col("doc_id")).count() == 4
