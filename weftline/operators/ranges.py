"""Running totals, quantiles and numbers over a global order, without a task that holds a whole group.

Rows are laid out by range over (group, order). A range's totals are one row
for each group that it holds, and prefix sums over these rows give each range its base;
inside a range a window adds up. So one group with all rows spreads over all
tasks, and only totals meet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .lineage import Tables


def same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """The condition that keys agree, nulls included."""
    out = F.lit(True)
    for k in keys:
        out = out & left[k].eqNullSafe(right[k])
    return out


class Ranges:
    """df as a written table in ranges of (by, order): rows has _part, which ascends with the order.

    order: names of columns; a minus before the name of a number means falling.
    """

    def __init__(self, df: DataFrame, by: list[str], order: list[str], tables: Tables | None = None) -> None:
        self.by, self.order = by, [F.desc(c[1:]) if c.startswith("-") else F.asc(c) for c in order]
        self.rising = [-F.col(c[1:]) if c.startswith("-") else F.col(c) for c in order]
        self.tables = tables or Tables(df.sparkSession)
        whole = self.tables.written(df, "whole")  # ranges are found by a sample, which would compute df twice
        laid = whole.repartitionByRange(*by, *self.order).withColumn("_part", F.spark_partition_id())
        self.rows = self.tables.written(laid, "ranges")
        self.tables.drop("whole")

    def running(self, values: list[str], ahead: list[str] | None = None) -> DataFrame:
        """rows with run_v, the sum of v up to the row, and all_v, that of the group; next_c is c of the next row."""
        by, ahead = self.by, ahead or []
        first = [F.min_by(F.struct(*ahead), F.struct(*self.rising)).alias("_h")] if ahead else []
        totals = self.rows.groupBy(*by, "_part").agg(*(F.sum(v).alias(f"_t_{v}") for v in values), *first)
        parts = Window.partitionBy(*by).orderBy("_part")  # a row for each range
        every = Window.partitionBy(*by)
        base = [(F.sum(f"_t_{v}").over(parts) - F.col(f"_t_{v}")).alias(f"_b_{v}") for v in values] + [F.sum(f"_t_{v}").over(every).alias(f"all_{v}") for v in values]
        bases = totals.select(*(F.col(b).alias(f"_k_{b}") for b in by), F.col("_part").alias("_q"), *base, *([F.lead("_h").over(parts).alias("_h")] if ahead else []))
        inner = Window.partitionBy(*by, "_part").orderBy(*self.order)
        run = inner.rowsBetween(Window.unboundedPreceding, 0)
        own = self.rows.select("*", *(F.sum(v).over(run).alias(f"_r_{v}") for v in values), *(F.lead(F.struct(*ahead)).over(inner).alias("_n") for _ in first))
        on = F.col("_part") == F.col("_q")
        for b in by:
            on = on & F.col(b).eqNullSafe(F.col(f"_k_{b}"))
        joined = own.join(bases, on)
        sums = [(F.col(f"_r_{v}") + F.col(f"_b_{v}")).alias(f"run_{v}") for v in values] + [F.col(f"all_{v}") for v in values]
        after = [F.coalesce("_n", "_h")[c].alias(f"next_{c}") for c in ahead]
        return joined.select(*(c for c in self.rows.columns if c != "_part"), *sums, *after)


def running_totals(df: DataFrame, by: list[str], order: list[str], values: list[str], ahead: list[str] | None = None) -> DataFrame:
    """df with running totals (run_), totals of groups (all_) and values of the next row (next_)."""
    return Ranges(df, by, order).running(values, ahead)


def numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """df with its rows' places from 0 in a global order; equal rows in any order."""
    rows = running_totals(df.withColumn("_one", F.lit(1).cast("long")), [], order, ["_one"])
    return rows.select(*df.columns, (F.col("run__one") - 1).alias(name))


def quantiles(df: DataFrame, by: list[str], value: str, at: list[float]) -> DataFrame:
    """by, k and quantile: the exact quantile at[k] of each group's values, between neighbours by linear interpolation.

    Values are counted first; the steps that hold a wanted rank are found by the running counts.
    """
    steps = df.filter(F.col(value).isNotNull()).groupBy(*by, F.col(value).cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    run = running_totals(steps, by, ["_v"], ["_c"])
    wanted = F.array(*(F.struct(F.lit(k).alias("k"), F.lit(float(q)).alias("q")) for k, q in enumerate(at)))

    def held(rank: Column) -> Column:
        return (rank >= F.col("run__c") - F.col("_c")) & (rank < F.col("run__c"))

    def place(x: Column) -> Column:
        return x["q"] * (F.col("all__c") - 1)

    hits = F.filter(wanted, lambda x: held(F.floor(place(x))) | held(F.ceil(place(x))))
    rows = run.filter(F.size(hits) > 0).select(*by, "_v", "_c", "run__c", "all__c", F.explode(hits).alias("x"))
    spot = F.col("x.q") * (F.col("all__c") - 1)
    ends = rows.select(*by, F.col("x.k").alias("k"), (spot - F.floor(spot)).alias("part"), F.when(held(F.floor(spot)), F.col("_v")).alias("lo"), F.when(held(F.ceil(spot)), F.col("_v")).alias("hi"))
    lo, hi, part = F.max("lo"), F.max("hi"), F.max("part")
    return ends.groupBy(*by, "k").agg(F.when(lo == hi, lo).otherwise((1 - part) * lo + part * hi).alias("quantile"))
