"""Writers: partitioned tables, predictions, JSON sidecars, report blocks, provenance."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_extract(df: DataFrame, path: str) -> None:
    """A DDI extract as CSV, one directory for each db and split."""
    df.write.mode("overwrite").partitionBy("db", "split").option("header", True).csv(path)


def write_features(df: DataFrame, path: str) -> None:
    """Feature vectors, partitioned so that a read prunes to one db, split and feature.

    (domain_id, protein_id) is a key; a repeated one is an error.
    """
    keys = ["db", "split", "feature", "domain_id", "protein_id"]
    if repeated := df.groupBy(*keys).count().filter("count > 1").head(1):
        raise ValueError(f"feature written twice: {repeated[0]}")
    df.write.mode("overwrite").partitionBy("db", "split", "feature").parquet(path)


def write_predictions(df: DataFrame, path: str) -> None:
    """Predictions as zstd Parquet, or CSV by suffix."""
    out = df.select(
        "domain_a", "domain_b", F.col("true_interaction").cast("byte"), F.col("predicted_interaction").cast("byte"), F.col("predicted_probability").cast("float")
    )
    if path.endswith(".csv"):
        out.write.mode("overwrite").option("header", True).csv(path)
    else:
        out.write.mode("overwrite").option("compression", "zstd").parquet(path)


def write_json_rows(df: DataFrame, path: str) -> None:
    """One JSON document for each row (metric sidecars)."""
    df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").text(path)


def write_blocks(blocks: DataFrame, path: str) -> None:
    """Report blocks (id, section_name, plot_type, pconfig, data), partitioned by id."""
    blocks.withColumn("block", F.col("id")).write.mode("overwrite").partitionBy("block").json(path)


def blocks_as_json(blocks: DataFrame) -> dict[str, str]:
    """A few report blocks as JSON text by id, streamed to the driver."""
    return {r.id: json.dumps(json.loads(r.j), indent=2) for r in blocks.select("id", F.to_json(F.struct("*")).alias("j")).toLocalIterator()}


# The classes of report blocks in the order of the report.
BLOCK_ORDER = ["metrics_table", "metrics_overview", "pairwise_significance", "roc", "pr", "database_analysis", "degree", "betweenness", "clustering"]


def ordered_ids(blocks: DataFrame) -> list[str]:
    """Block ids by class, then by name: the report's module order."""
    rank = F.lit(len(BLOCK_ORDER))
    for k, name in reversed(list(enumerate(BLOCK_ORDER))):
        rank = F.when(F.col("id").rlike(rf"(^|_){name}(_|$)"), k).otherwise(rank)
    return [r.id for r in blocks.select("id", rank.alias("r")).orderBy("r", "id").toLocalIterator()]


def order_yaml(ids: list[str]) -> str:
    return "report_section_order:\n" + "".join(f"  {i}:\n    order: {10 * (len(ids) - k)}\n" for k, i in enumerate(ids)) + "custom_content:\n  order:\n" + "".join(f"    - {i}\n" for i in ids)


def save_params(spark: SparkSession, path: str, model: str, params: dict, balance_method: str | None, threshold: float | None) -> None:
    row = [(model, {k: str(v) for k, v in params.items()}, balance_method, threshold)]
    spark.createDataFrame(row, "model string, model_parameters map<string,string>, balance_method string, threshold double").coalesce(1).write.mode("overwrite").json(path)


def provenance(spark: SparkSession) -> DataFrame:
    from .. import __version__

    return spark.createDataFrame([("weftline", __version__), ("spark", spark.version)], "component string, version string")
