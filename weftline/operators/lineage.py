"""Cutting a plan's lineage, and tables of one call, in the folder that the cluster shares."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def _base(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Only a local master without the setting (tests) gets a folder of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return folder or "/tmp/checkpoints"


def shared_folder(spark: SparkSession) -> str:
    """The URI of a fresh folder below spark.checkpoint.dir."""
    base = _base(spark)
    return f"{'file://' if base.startswith('/') else ''}{base.rstrip('/')}/weftline-{uuid.uuid4().hex}"


def local_path(uri: str) -> str:
    """The path of a folder that every executor mounts, for formats that Spark has no writer for."""
    path = uri.removeprefix("file://") if uri.startswith("file://") else uri.removeprefix("file:")
    if "://" in path:
        raise ValueError(f"{uri} isn't a mounted folder")
    return path


def cut(df: DataFrame) -> DataFrame:
    """df, computed and kept by checkpoint() below spark.checkpoint.dir, so lost executors lose nothing."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(_base(spark))
    return df.checkpoint(eager=True)


class Tables:
    """Written tables of one call: their sizes are known to the planner, whatever plan made them."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.root = spark, shared_folder(spark)

    def written(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").option("compression", "zstd").parquet(f"{self.root}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{name}")

    def drop(self, name: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
