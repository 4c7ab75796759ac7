"""Five stages from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept,
and returns a DataFrame that is written as Parquet and read again as the next
one's docs. All but the last return the columns of documents.

Nulls and empties, in every stage: a null text has no words, so the quality
rules reject it; null ids, langs and sources are values like others; of rows
that repeat a document one place keeps the lines, and the rows of one doc_id
that are near duplicates stay or go alike; extra columns pass through under
their names, whatever they are. Of ties the smallest doc_id stays. An empty
table gives an empty result of the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm import decontaminate, line_dedup, near_dedup, packing, quality
from weftline.llm.runtime import Scratch, quoted


def _tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the adaptive quality rules keep; those without 50 words, null and empty ones included, go."""
    return quality.filter_documents(docs)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier line is within one word of; those left without a word go, and n_chars is counted anew where a line went."""
    out = line_dedup.dedup_lines(docs)
    removed = F.col(quoted(out.columns[-1])) > 0
    emptied = removed & ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    out = out.filter(~F.coalesce(emptied, F.lit(False)))
    n_chars = F.when(removed, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", n_chars).select(*map(quoted, docs.columns))


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, of each group whose five-word shingles are similar to 0.8 or more; those without a word, or all without id, stay."""
    return near_dedup.keep_one(docs, size=5, percent=80)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of ten words of the benchmark, or all words of a shorter item; an empty benchmark drops none."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    found = decontaminate.find(docs, items, window=10)
    return found.filter(F.col(quoted(found.columns[-2])).isNull()).select(*map(quoted, docs.columns))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 4096 token ids; a null text is its end id alone, an empty table gives no piece."""
    return packing.pack(docs, _tokenizer(), window=4096, end_id=2)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_deduplication),
    ("near_dedup", near_deduplication),
    ("decontamination", benchmark_decontamination),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES[:-1]):
        docs = scratch.table(stage(spark, docs, sf_dir), name)
        if k:
            scratch.drop(STAGES[k - 1][0])
    return STAGES[-1][1](spark, docs, sf_dir)


#: SQL has neither the edit-distance joins, the quantile summaries nor the tokenizer; tests compare the stages with brute force.
ORACLE_SQL = None
