"""Readers of CSV, JSON, Parquet and ontology files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PREDICTION_SCHEMA = "domain_a string, domain_b string, true_interaction byte, predicted_interaction byte, predicted_probability float"
PREDICTION_COLUMNS = {"domain_a": "string", "domain_b": "string", "true_interaction": "byte", "predicted_interaction": "byte", "predicted_probability": "float"}


def read_samplesheet(spark: SparkSession, path: str, root: str = "") -> DataFrame:
    """id and db_path of each row; relative paths are below root, a missing id is the directory's name."""
    rows = spark.read.schema("id string, db_path string").option("header", True).csv(path)
    here = F.when(F.col("db_path").startswith("/") | F.col("db_path").contains("://"), F.col("db_path")).otherwise(F.concat(F.lit(root.rstrip("/") + "/" if root else ""), F.col("db_path")))
    named = rows.select(F.nullif(F.trim("id"), F.lit("")).alias("id"), here.alias("db_path"))
    return named.select(F.coalesce("id", F.element_at(F.split(F.regexp_replace("db_path", "/+$", ""), "/"), -1)).alias("id"), "db_path")


def samplesheet_faults(rows: DataFrame) -> DataFrame:
    """Rows of a samplesheet that break its rules, with the reason."""
    rule = F.when(F.col("db_path").isNull() | ~F.col("db_path").rlike(r"^\S+$"), F.lit("db_path must be a path without spaces")).when(~F.col("id").rlike(r"^\S+$"), F.lit("id must not hold spaces"))
    double = rows.groupBy("id").agg(F.count(F.lit(1)).alias("_n"))
    told = rows.join(double, "id", "left").select("id", "db_path", F.coalesce(rule, F.when(F.col("_n") > 1, F.lit("id must be unique"))).alias("fault"))
    return told.filter("fault IS NOT NULL")


def read_ddi_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("domain_1 string, domain_2 string, interaction int").option("header", True).csv(path)


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """Predictions from Parquet, or CSV by suffix, with narrow types; missing columns are an error."""
    found = spark.read.option("header", True).csv(path) if str(path).rstrip("/").endswith(".csv") else spark.read.parquet(path)
    if missing := [c for c in PREDICTION_COLUMNS if c not in found.columns]:
        raise ValueError(f"{path} lacks the columns {', '.join(missing)}")
    return found.select(*(F.col(c).cast(t) for c, t in PREDICTION_COLUMNS.items()))


def read_prediction_tree(spark: SparkSession, pattern: str) -> DataFrame:
    """Predictions of many models: model and db are the two directories above each file."""
    found = spark.read.schema(PREDICTION_SCHEMA).parquet(pattern)
    parts = F.split(F.col("_metadata.file_path"), "/")
    return found.select("*", F.element_at(parts, -2).alias("model"), F.element_at(parts, -3).alias("db"))


def read_json(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def read_properties(spark: SparkSession, path: str, key: str = "aa") -> DataFrame:
    """A residue property table: its first column is the residue, the others doubles in file order."""
    rows = spark.read.option("header", True).csv(path)
    first, *others = rows.columns
    return rows.select(F.col(f"`{first}`").alias(key), *(F.col(f"`{c}`").cast("double").alias(c) for c in others))


def ontology_edges(spark: SparkSession, path: str, namespace: str = "molecular_function") -> DataFrame:
    """parent, child of the is_a relations between live terms of a namespace; Spark splits the OBO text into its stanzas."""
    stanzas = spark.read.option("lineSep", "\n[Term]\n").text(path)
    # A stanza goes up to the next one of another kind; the file's head has no id.
    own = stanzas.select(F.split(F.regexp_replace("value", r"^\s*\[Term\]\s*\n", ""), r"\n\[")[0].alias("s"))
    field = lambda key: F.regexp_extract("s", rf"(?m)^{key}:[ \t]*(\S+)", 1)
    live = own.filter((field("id") != "") & (field("namespace") == namespace) & (field("is_obsolete") != "true"))
    terms = live.select(field("id").alias("child"), F.regexp_extract_all("s", F.lit(r"(?m)^is_a:[ \t]*(\S+)"), 1).alias("p"))
    edges = terms.select(F.explode("p").alias("parent"), "child").distinct()
    return edges.join(terms.select(F.col("child").alias("parent")).distinct(), "parent", "left_semi")


def ontology_levels(edges: DataFrame, most: int = 100) -> DataFrame:
    """term, level (shortest path from a root) and depth (longest), by one join for each step away from the roots.

    A relation without end (a cycle, or paths of over `most` steps) is an error.
    """
    from ..operators.lineage import Tables

    tables = Tables(edges.sparkSession)
    edges = tables.written(edges, "edges")
    at = edges.select(F.col("parent").alias("term")).distinct().join(edges.select(F.col("child").alias("term")), "term", "left_anti").withColumn("step", F.lit(0))
    steps = None
    for k in range(1, most + 2):
        at = tables.written(at, f"step-{k}")
        steps = at if steps is None else steps.unionByName(at)
        if at.isEmpty():
            return steps.groupBy("term").agg(F.min("step").alias("level"), F.max("step").alias("depth"))
        at = at.join(edges, F.col("term") == F.col("parent")).select(F.col("child").alias("term")).distinct().withColumn("step", F.lit(k))
    raise ValueError(f"the ontology has a cycle, or paths of over {most} steps")


def read_ontology(spark: SparkSession, path: str, namespace: str = "molecular_function") -> DataFrame:
    """parent, child, and the child's depth (longest path from the root) and level (shortest)."""
    edges = ontology_edges(spark, path, namespace)
    levels = ontology_levels(edges).select(F.col("term").alias("child"), "depth", "level")
    return edges.join(levels, "child").select("parent", "child", "depth", "level")
