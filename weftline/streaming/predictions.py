"""Incremental evaluation: new prediction files become merged metric rows as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.evaluation import evaluate
from ..operators.report import merged
from ..sources.files import PREDICTION_SCHEMA

METRICS = ["samples", "accuracy", "balanced_accuracy", "f1", "mcc", "roc_auc", "pr_ap"]


def watch(spark: SparkSession, folder: str) -> DataFrame:
    """A stream of predictions below folder/<db>/<model>/."""
    rows = spark.readStream.schema(PREDICTION_SCHEMA).option("recursiveFileLookup", True).parquet(folder)
    parts = F.split(F.col("_metadata.file_path"), "/")
    return rows.select("*", F.element_at(parts, -2).alias("model"), F.element_at(parts, -3).alias("db"))


def upsert_metrics(stream: DataFrame, table: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Evaluate each batch by db and model and merge it into the Parquet table at `table`; new values win.

    A batch writes a version of its own, v=<batch>, so a batch that is replayed
    after a failure writes the same version again.
    """

    def step(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        new = evaluate(batch, ["db", "model"]).select("db", "model", *(F.col(m).cast("double").alias(m) for m in METRICS))
        old = latest(spark, table, number)
        out = new if old is None else merged(old, new, ["db", "model"], METRICS)
        out.write.mode("overwrite").parquet(f"{table}/v={number:06d}")

    writer = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def latest(spark: SparkSession, table: str, before: int | None = None) -> DataFrame | None:
    """The newest version of the metric table, or the newest before a batch; None if there is none."""
    path = spark._jvm.org.apache.hadoop.fs.Path(table)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(path):
        return None
    names = sorted(s.getPath().getName() for s in store.listStatus(path))
    names = [n for n in names if n.startswith("v=") and (before is None or int(n[2:]) < before)]
    return spark.read.parquet(f"{table}/{names[-1]}") if names else None
