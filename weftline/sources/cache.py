"""Computed tables kept by a content key, and reused while their shape is right."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def kept(spark: SparkSession, path: str, key: str, rows: int | None, make: Callable[[], DataFrame]) -> DataFrame:
    """The table at path/key=<key> if it is whole (written to its end, and of `rows` rows), else make() written there."""
    where = f"{path}/key={key}"
    jvm = spark._jvm
    done = jvm.org.apache.hadoop.fs.Path(f"{where}/_SUCCESS")
    if done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done):
        found = spark.read.parquet(where)
        if rows is None or found.count() == rows:
            return found
    make().write.mode("overwrite").parquet(where)
    return spark.read.parquet(where)
