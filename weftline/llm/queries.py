"""The registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .oracles import ORACLES


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lm_scoring import score

    learn = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 7 != 2
    return score(_docs(spark, sf_dir), learn, keep_model=False)[0]


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack

    pieces = pack(_docs(spark, sf_dir), _tokenizer("word_bpe_49k.json"), window=4096, end_id=2)
    return pieces.drop("ids", "boundary")


def op4_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_output import export_ids, read_ids

    parts, folder = export_ids(_docs(spark, sf_dir), _tokenizer("word_bpe_49k.json"), end_id=1)
    return read_ids(parts, folder).drop("ids")


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .near_dedup import classes

    return classes(_docs(spark, sf_dir), size=2, percent=80).drop("t")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sharding import shard_rows

    text = F.coalesce(F.col("text"), F.lit(""))
    size = (F.octet_length(text) + F.lit(16)).cast("long")
    out = shard_rows(_docs(spark, sf_dir).select("doc_id", "text"), 40, size, F.col("text"), F.col("doc_id"))
    return out.select("doc_id", size.alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_counts import count_tokens

    counts = count_tokens(_docs(spark, sf_dir), _tokenizer("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 1024)


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import digest, find

    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return digest(find(_docs(spark, sf_dir).select("doc_id", "text"), items, window=10))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .line_dedup import dedup_lines

    out = dedup_lines(_docs(spark, sf_dir), keep_columns=["doc_id", "text"]).toDF("doc_id", "text", "n_lines", "n_removed")
    text = F.coalesce(F.col("text"), F.lit(""))
    return out.select("doc_id", "n_lines", "n_removed", F.md5(F.encode(text, "UTF-8")).alias("text_md5"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language_id import predict, prototypes

    docs = _docs(spark, sf_dir)
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 4 == 2
    names, profiles = prototypes(docs.filter(~held_out), dims=512)
    return predict(docs, names, profiles).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import judge

    judged = judge(_docs(spark, sf_dir), keep_columns=["doc_id"])
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("doc_id", *(F.col(f"_wf_{c}").alias(c) for c in (*counts, "base_failed", "kept")))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .divergence import divergence

    return divergence(_docs(spark, sf_dir), least_docs=30, prior=5, top=50)


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .whitening import whiten

    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), components=4, scale=256)


def op13_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality_classifier import classify

    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 4 == 2
    scored = classify(_docs(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"), learn=~held_out)[0]
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_lm_scoring, op2_token_counts, op3_packing, op4_token_output, op5_near_dedup, op6_sharding, op7_decontamination, op8_line_dedup, op9_language_id, op10_quality, op11_source_divergence, op12_embedding_whitening, op13_quality_classifier)
}

__all__ = ["ORACLES", "QUERIES"]
