"""A Spark data source over SQLite files: rowid ranges as partitions, filters pushed down.

    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(SqliteSource)
    spark.read.format("sqlite_table").option("path", p).option("table", "protein").load()
"""

from __future__ import annotations

import glob
import os
import sqlite3
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual
from pyspark.sql.types import StructType

_KINDS = {"INT": "bigint", "BOOL": "boolean", "CHAR": "string", "TEXT": "string", "CLOB": "string", "REAL": "double", "FLOA": "double", "DOUB": "double", "BLOB": "binary"}
_COMPARE = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _open(path: str) -> sqlite3.Connection:
    if not os.path.exists(path):
        raise FileNotFoundError(path)
    return sqlite3.connect(f"file:{path}?mode=ro", uri=True)


def _files(path: str) -> list[str]:
    """The file at path, or the SQLite files of a folder that aren't empty."""
    if not os.path.isdir(path):
        return [path]
    found = [p for p in sorted(glob.glob(f"{glob.escape(path)}/*.sqlite3")) if os.path.getsize(p)]
    if not found:
        raise FileNotFoundError(f"{path} holds no SQLite file")
    return found


class RowRange(InputPartition):
    def __init__(self, path: str, lo: int, hi: int) -> None:
        self.path, self.lo, self.hi = path, lo, hi


class SqliteReader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType) -> None:
        self.path, self.name = options["path"], options["table"]
        self.rows = int(options.get("rows_per_partition", 50_000))
        self.chunk = int(options.get("chunk_rows", 5_000))
        self.schema = schema
        self.where: list[str] = []
        self.values: list = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Comparisons, IN and null tests on columns run inside SQLite; others are handed back."""
        for f in filters:
            column = _quoted(f.attribute[0]) if len(getattr(f, "attribute", ())) == 1 else None
            if column and type(f) in _COMPARE and isinstance(f.value, (int, float, str)):
                self.where.append(f"{column} {_COMPARE[type(f)]} ?")
                self.values.append(f.value)
            elif column and isinstance(f, In) and all(isinstance(v, (int, float, str)) for v in f.value):
                self.where.append(f"{column} IN ({', '.join('?' * len(f.value))})")
                self.values += list(f.value)
            elif column and isinstance(f, IsNotNull):
                self.where.append(f"{column} IS NOT NULL")
            elif column and isinstance(f, IsNull):
                self.where.append(f"{column} IS NULL")
            else:
                yield f

    def partitions(self) -> list[RowRange]:
        out = []
        for path in _files(self.path):
            with _open(path) as db:
                lo, hi = db.execute(f"SELECT min(rowid), max(rowid) FROM {_quoted(self.name)}").fetchone()
            if lo is not None:
                out += [RowRange(path, a, min(a + self.rows, hi + 1)) for a in range(lo, hi + 1, self.rows)]
        return out or [RowRange(_files(self.path)[0], 0, 0)]

    def read(self, partition: RowRange) -> Iterator[tuple]:
        columns = ", ".join(_quoted(f.name) for f in self.schema)
        test = " AND ".join([f"rowid >= {partition.lo} AND rowid < {partition.hi}", *self.where])
        boolean = [k for k, f in enumerate(self.schema) if f.dataType.simpleString() == "boolean"]
        with _open(partition.path) as db:
            cursor = db.execute(f"SELECT {columns} FROM {_quoted(self.name)} WHERE {test}", self.values)
            while rows := cursor.fetchmany(self.chunk):
                for row in rows:
                    out = list(row)
                    for k in boolean:
                        out[k] = None if out[k] is None else bool(out[k])
                    yield tuple(out)


class SqliteSource(DataSource):
    """Options: path (a file, or a folder of files with the same table), table, rows_per_partition (50000), chunk_rows (5000)."""

    @classmethod
    def name(cls) -> str:
        return "sqlite_table"

    def schema(self) -> str:
        with _open(_files(self.options["path"])[0]) as db:
            found = db.execute(f"PRAGMA table_info({_quoted(self.options['table'])})").fetchall()
        if not found:
            raise ValueError(f"{self.options['path']} has no table {self.options['table']}")
        kind = lambda t: next((v for k, v in _KINDS.items() if k in t.upper()), "string")
        return ", ".join(f"`{r[1]}` {kind(r[2])}" for r in found)

    def reader(self, schema: StructType) -> SqliteReader:
        return SqliteReader(self.options, schema)


def read_table(spark: SparkSession, path: str, table: str, schema: str | None = None, rows_per_partition: int = 50_000) -> DataFrame:
    """A table of a SQLite file. Spark reads sources that take filters only with their pushdown on, so it is turned on."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(SqliteSource)
    reader = spark.read.format("sqlite_table").option("path", path).option("table", table).option("rows_per_partition", rows_per_partition)
    return (reader.schema(schema) if schema else reader).load()


_SQL_KINDS = {"boolean": "BOOLEAN", "string": "TEXT", "binary": "BLOB", "float": "REAL", "double": "REAL"}


def write_table(df: DataFrame, folder: str, table: str) -> None:
    """df as SQLite files below folder (a path that all executors mount), one for each partition.

    A file appears under its name only when it is whole, so a task that runs
    again replaces it.
    """
    kinds = [(f.name, _SQL_KINDS.get(f.dataType.simpleString(), "INTEGER")) for f in df.schema]

    def run(rows: Iterator) -> None:
        from pyspark import TaskContext

        os.makedirs(folder, exist_ok=True)
        end = f"{folder}/part-{TaskContext.get().partitionId():05d}.sqlite3"
        part = f"{end}.{uuid.uuid4().hex[:8]}"
        with sqlite3.connect(part) as db:
            db.execute(f"CREATE TABLE {_quoted(table)} ({', '.join(f'{_quoted(n)} {k}' for n, k in kinds)})")
            db.executemany(f"INSERT INTO {_quoted(table)} VALUES ({', '.join('?' * len(kinds))})", (tuple(bytes(v) if isinstance(v, bytearray) else v for v in r) for r in rows))
        db.close()
        os.replace(part, end)

    df.foreachPartition(run)


SPLITS = ("train", "test", "optimization")


def split_files(db_path: str) -> dict[str, str]:
    """The split files of a database directory; a single file counts as its test split.

    Splits that are absent are left out; a path that doesn't exist is an error.
    """
    if not os.path.exists(db_path):
        raise FileNotFoundError(db_path)
    if os.path.isfile(db_path):
        return {"test": db_path}
    found = {s: f"{db_path}/{s}.sqlite3" for s in SPLITS}
    return {s: p for s, p in found.items() if os.path.exists(p) and os.path.getsize(p)}


def read_splits(spark: SparkSession, db_path: str, db: str, table: str, schema: str | None = None) -> DataFrame:
    """A table of all splits of a database, with db and split as columns."""
    from functools import reduce

    from pyspark.sql import functions as F

    parts = [read_table(spark, p, table, schema).withColumns({"db": F.lit(db), "split": F.lit(s)}) for s, p in split_files(db_path).items()]
    if not parts:
        raise FileNotFoundError(f"{db_path} has no split")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
