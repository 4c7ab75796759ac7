"""The task catalogue: databases, splits, features, combinations and models as rows.

The reference class of tools schedules a process for each cell; here a cell is
a row, and db, split, feature and model are columns of one plan.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def option_list(text: str | None, skip: str | None = None) -> list[str]:
    """A comma list without blanks, `none`, and the names of skip."""
    split = lambda t: [x.strip() for x in (t or "").split(",")]
    out = {x.lower() for x in split(skip)}
    return [x for x in dict.fromkeys(split(text)) if x and x.lower() != "none" and x.lower() not in out]


def option_array(text: Column, skip: Column) -> Column:
    """option_list as an expression."""
    clean = lambda c: F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ","), lambda x: F.trim(x)), lambda x: (x != "") & (F.lower(x) != "none"))
    return F.array_except(clean(text), clean(skip))


def feature_combinations(features: list[str]) -> list[list[str]]:
    """Each feature alone, and all together if there are two or more."""
    return [[f] for f in features] + ([list(features)] if len(features) > 1 else [])


def tasks(spark: SparkSession, sheet: DataFrame, splits: list[str], features: list[str], models: list[str]) -> tuple[DataFrame, DataFrame]:
    """Feature tasks (db, split, feature) and model tasks (db, model, combo_id, features); catalogue-sized crosses."""
    dbs = sheet.select(F.col("id").alias("db"), "db_path")
    cells = spark.createDataFrame([(s, f) for s in splits for f in features], "split string, feature string")
    combos = spark.createDataFrame([("+".join(c), c, m) for c in feature_combinations(features) for m in models], "combo_id string, features array<string>, model string")
    return dbs.crossJoin(F.broadcast(cells)), dbs.crossJoin(F.broadcast(combos))


def grouped(df: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Lists of values by key, in order of value (groupTuple)."""
    return df.groupBy(*keys).agg(*(F.array_sort(F.collect_list(v)).alias(v) for v in values))


def routed(df: DataFrame, **tests: Column) -> dict[str, DataFrame]:
    """Rows by the first test they pass; `other` holds the rest (branch)."""
    left, out = F.lit(True), {}
    for name, test in tests.items():
        test = F.coalesce(test, F.lit(False))
        out[name] = df.filter(left & test)
        left = left & ~test
    return out | {"other": df.filter(left)}


def mixed(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows of several frames with the same columns (mix)."""
    for o in others:
        first = first.unionByName(o)
    return first


def keyed(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Tasks with the results of their key (join of keyed channels); a task without one drops out."""
    return left.join(right, keys)


def sorted_text(df: DataFrame, column: str) -> DataFrame:
    """One row: all values, sorted, a line each (collectFile for version lines)."""
    return df.agg(F.array_join(F.array_sort(F.collect_list(column)), "\n").alias("text"))


class Registry:
    """Named plug-ins of a level, domain or pair: name -> function of DataFrames giving keys and vec."""

    def __init__(self) -> None:
        self._found: dict[str, tuple[str, Callable[..., DataFrame]]] = {}

    def add(self, name: str, level: str = "domain") -> Callable:
        if level not in ("domain", "pair"):
            raise ValueError(f"no such level: {level}")

        def put(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
            self._found[name] = (level, f)
            return f

        return put

    def __getitem__(self, name: str) -> Callable[..., DataFrame]:
        if name not in self._found:
            raise KeyError(f"no feature named {name}; known: {', '.join(sorted(self._found))}")
        return self._found[name][1]

    def level(self, name: str) -> str:
        return self._found[name][0]

    def names(self, level: str | None = None) -> list[str]:
        return [n for n, (own, _) in self._found.items() if level in (None, own)]
