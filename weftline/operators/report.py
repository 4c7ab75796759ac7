"""Report tables and blocks, within a database and across databases, with incremental merges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import ci_text, lenient_double, p_text
from .graph import degree_histogram


def merged(old: DataFrame, new: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Old and new rows by key; where both have a value the new one wins."""
    o = old.select(*keys, *(F.col(v).alias(f"_o_{v}") for v in values))
    return o.join(new.select(*keys, *values), keys, "full_outer").select(*keys, *(F.coalesce(v, f"_o_{v}").alias(v) for v in values))


def old_names(blocks: DataFrame, pattern: str = r"_([A-Za-z0-9-]+)$") -> DataFrame:
    """Database names that the ids of an earlier report's blocks end in."""
    return blocks.select(F.regexp_extract("id", pattern, 1).alias("db")).filter("db != ''").distinct()


def auc_table(areas: DataFrame, intervals: DataFrame | None = None) -> DataFrame:
    """model, roc_auc, roc_auc_ci, pr_ap, pr_ap_ci; intervals: model, roc_lo, roc_hi, pr_lo, pr_hi."""
    if intervals is None:
        return areas.select("model", "roc_auc", F.lit(None).cast("string").alias("roc_auc_ci"), "pr_ap", F.lit(None).cast("string").alias("pr_ap_ci"))
    rows = areas.join(intervals, "model", "left")
    return rows.select("model", "roc_auc", F.when(F.col("roc_lo").isNotNull(), ci_text(F.col("roc_lo"), F.col("roc_hi"))).alias("roc_auc_ci"), "pr_ap", F.when(F.col("pr_lo").isNotNull(), ci_text(F.col("pr_lo"), F.col("pr_hi"))).alias("pr_ap_ci"))


def curves_by(points: DataFrame, by: list[str], x: str, y: str, order: list[Column]) -> DataFrame:
    """by and points, a list of (x, y) in order; curves are decimated before, so lists are bounded."""
    keyed = points.select(*by, F.struct(*(o.alias(f"_{k}") for k, o in enumerate(order)), F.col(x).alias("x"), F.col(y).alias("y")).alias("_p"))
    return keyed.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list("_p")), lambda p: F.struct(p.x.alias("x"), p.y.alias("y"))).alias("points"))


def overview(metrics: DataFrame, names: list[str]) -> DataFrame:
    """Metrics as rows: metric, and a map from model to value."""
    long = metrics.select("model", *(F.col(n).cast("double").alias(n) for n in names)).unpivot("model", names, "metric", "value")
    return long.groupBy("metric").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("model", "value")))).alias("models"))


def significance_grid(pairs: DataFrame) -> DataFrame:
    """model_a and a map from the other models to p as text."""
    cells = pairs.select("model_a", F.struct("model_b", p_text(F.col("p")).alias("v")).alias("e"))
    return cells.groupBy("model_a").agg(F.map_from_entries(F.array_sort(F.collect_list("e"))).alias("p"))


def db_analysis(networks: DataFrame, interactions: DataFrame) -> DataFrame:
    """name ("SPLIT - KIND") and the five network figures. Both inputs have split and kind."""
    rows = networks.join(interactions, ["split", "kind"])
    return rows.select(
        F.concat(F.upper("split"), F.lit(" - "), F.upper("kind")).alias("name"), "num_nodes", "num_edges", "total_interactions", "num_positive_interactions", "num_negative_interactions"
    )


def distributions(degrees: DataFrame) -> DataFrame:
    """kind and a map from split to the degrees' histogram, (degree, nodes) in order of degree."""
    lists = degree_histogram(degrees, ["kind", "split"])
    return lists.groupBy("kind").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("split", F.col("degree_distribution").alias("v"))))).alias("data"))


def heatmap(values: DataFrame, dbs: list[str] | None = None) -> DataFrame:
    """model by db mean values; label: "0.948 [0.930, 0.960]" or a number."""
    rows = values.select("model", "db", lenient_double(F.col("value").cast("string")).alias("v"))
    return rows.groupBy("model").pivot("db", dbs).agg(F.avg("v")) if dbs else rows.groupBy("model").pivot("db").agg(F.avg("v"))


def heatmap_labels(values: DataFrame, dbs: list[str]) -> DataFrame:
    return values.groupBy("model").pivot("db", dbs).agg(F.first("value"))


def cross_db_curves(points: DataFrame, x: str, y: str, order: list[Column]) -> tuple[DataFrame, DataFrame]:
    """For each model a map db -> points, and for each db a map model -> points."""
    own = curves_by(points, ["db", "model"], x, y, order)
    pack = lambda key: F.map_from_entries(F.array_sort(F.collect_list(F.struct(key, "points")))).alias("data")
    return own.groupBy("model").agg(pack("db")), own.groupBy("db").agg(pack("model"))


def block(rows: DataFrame, block_id: str, section: str, plot: str, title: str, data: Column, db: str | None = None) -> DataFrame:
    """One report block: id, section_name, plot_type, pconfig, data (a JSON text of what rows aggregate to)."""
    own = f"{block_id}_{db}" if db else block_id
    head = f"{section} ({db})" if db else section
    config = F.create_map(F.lit("id"), F.lit(own), F.lit("title"), F.lit(f"{title} ({db})" if db else title))
    return rows.agg(data.alias("data")).select(F.lit(own).alias("id"), F.lit(head).alias("section_name"), F.lit(plot).alias("plot_type"), config.alias("pconfig"), F.to_json("data").alias("data"))


def pass_through(blocks: DataFrame, classes: list[str]) -> DataFrame:
    """Blocks of none of the classes, matched by whole parts of the id, so a database's name can't drop a block."""
    drop = F.lit(False)
    for c in classes:
        drop = drop | F.col("id").rlike(rf"^(?:[a-z]+_)?{c}(?:_|$)")
    return blocks.filter(~drop)
