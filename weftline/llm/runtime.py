"""Scratch tables in the shared folder, and prefix sums over partition totals."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession

LOCAL_FALLBACK = "file:///tmp/checkpoints"


def fresh(taken: list[str], *names: str) -> list[str]:
    """names, each with underscores put behind it until none of taken has it, whatever the case."""
    used, out = {t.lower() for t in taken}, []
    for name in names:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out


def quoted(name: str) -> str:
    """name as a reference to a column, dots and backticks included."""
    return "`" + name.replace("`", "``") + "`"


def neutral(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """df with its columns called u0, u1, ..., and each column's new name: no name of its own can meet an inner one."""
    names = [f"u{k}" for k in range(len(df.columns))]
    return df.toDF(*names), dict(zip(df.columns, names))


def spread_join(left: DataFrame, right: DataFrame, keys: list[str], parts: int = 1000) -> DataFrame:
    """left joined with right, which has one row for each key; left is a written table.

    Keys with over a parts-th part of left's rows, fewer than parts, meet a
    broadcast of their rows of right, so their rows of left stay where they are.
    """
    from pyspark.sql import functions as F

    hot = F.broadcast(left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > left.count() / parts).select(*keys))
    few = F.broadcast(right.join(hot, keys, "left_semi"))
    return left.join(few, keys).unionByName(left.join(hot, keys, "left_anti").join(right, keys))


def exact_keys(spark: SparkSession, n: int) -> np.ndarray:
    """For each of n partitions an integer that repartition(n, key) sends there.

    Numbers from 0 to n - 1 themselves would meet by their hashes, several in
    some tasks and none in others.
    """
    from pyspark.sql import functions as F

    found, lo = {}, 0
    while len(found) < n:
        step = max(1000, 4 * n)
        k = F.col("id").cast("int")
        for r in spark.range(lo, lo + step).groupBy(F.pmod(F.hash(k), F.lit(n)).alias("p")).agg(F.min(k).alias("k")).collect():  # n rows at most
            found.setdefault(r.p, r.k)
        lo += step
    return np.array([found[p] for p in range(n)], np.int32)


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder path below spark.checkpoint.dir.

    The setting is read from the session. Only a local master without the
    setting (tests) gets a default; a cluster without it is an error, since a
    machine-local folder would be lost with its executor.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = LOCAL_FALLBACK
    if "://" not in base and base.startswith("/"):
        base = "file://" + base
    return f"{base.rstrip('/')}/weftline/{uuid.uuid4().hex}"


class Scratch:
    """Written tables of one operator call; drop() removes those no longer read."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.root = shared_dir(spark)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        """Write df, and return the reread table: it cuts lineage and survives lost executors."""
        path = self.path(name)
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        jvm = self.spark._jvm
        conf = self.spark._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.path(name))
            path.getFileSystem(conf).delete(path, True)


def partition_bases(table: DataFrame, part: str, value: str) -> dict[int, int]:
    """Exclusive prefix sums of value's totals over part, in the order of part.

    One row for each written partition comes to the driver, which tracks as
    many tasks anyway (about 24 bytes each), never one for each document.
    """
    from pyspark.sql import functions as F

    total, bases = 0, {}
    for row in table.groupBy(part).agg(F.sum(value).alias("n")).orderBy(part).collect():
        bases[row[0]] = total
        total += int(row["n"] or 0)
    return bases
