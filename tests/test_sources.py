import io
import pickle
import sqlite3

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftline.functions.vectors import decode_array, decode_vector, slice_mean
from weftline.sources import files, sinks, sqlite_source


@pytest.fixture
def db(tmp_path):
    path = tmp_path / "train.sqlite3"
    with sqlite3.connect(path) as c:
        c.execute("CREATE TABLE ppi (a INTEGER, b INTEGER, score INT, negative BOOLEAN, name TEXT, v BLOB)")
        c.executemany("INSERT INTO ppi VALUES (?, ?, ?, ?, ?, ?)", [(k, k + 1, k % 1000, None if k % 5 == 0 else k % 2, None if k % 7 == 0 else f"n{k}", pickle.dumps(np.arange(3, dtype=np.float32) + k)) for k in range(2500)])
    return tmp_path


def test_sqlite_rows_types_and_pushdown(spark, db):
    df = sqlite_source.read_table(spark, str(db / "train.sqlite3"), "ppi", rows_per_partition=600)
    assert df.rdd.getNumPartitions() == 5 and df.count() == 2500
    assert [f.dataType.simpleString() for f in df.schema] == ["bigint", "bigint", "bigint", "boolean", "string", "binary"]
    kept = df.filter("score > 900 AND name IS NOT NULL").select("a", "score", "negative")
    want = [k for k in range(2500) if k % 1000 > 900 and k % 7]
    assert sorted(r.a for r in kept.collect()) == want
    assert kept.filter("negative IS NULL").count() == sum(k % 5 == 0 for k in want)
    vec = df.filter("a = 4").select(decode_vector("v").alias("x")).first().x
    assert vec == [4.0, 5.0, 6.0]


def test_splits(spark, db):
    (db / "test.sqlite3").write_bytes(b"")
    assert set(sqlite_source.split_files(str(db))) == {"train"}
    assert sqlite_source.split_files(str(db / "train.sqlite3")) == {"test": str(db / "train.sqlite3")}
    rows = sqlite_source.read_splits(spark, str(db), "d1", "ppi")
    assert {tuple(r) for r in rows.select("db", "split").distinct().collect()} == {("d1", "train")}
    with pytest.raises(FileNotFoundError):
        sqlite_source.split_files(str(db / "absent"))


def test_blobs_hold_arrays_only():
    class Bad:
        def __reduce__(self):
            return (print, ("run",))

    with pytest.raises(pickle.UnpicklingError):
        decode_array(pickle.dumps(Bad()))
    assert decode_array(pickle.dumps(np.eye(2))).shape == (2, 2)
    buffer = io.BytesIO()
    pickle.dump(np.arange(4), buffer, protocol=2)
    assert decode_array(buffer.getvalue()).tolist() == [0, 1, 2, 3]


def test_slice_mean(spark):
    df = spark.sql("SELECT array(array(1f, 2f), array(3f, 4f), array(5f, 6f)) AS m")
    row = df.select(slice_mean(F.col("m"), F.lit(1), F.lit(3)).alias("x"), slice_mean(F.col("m"), F.lit(2), F.lit(2)).alias("none")).first()
    assert row.x == [4.0, 5.0] and row.none is None


def test_samplesheet(spark, tmp_path):
    (tmp_path / "s.csv").write_text("id,db_path\none,data/a\n,data/b/\nx y,/abs/c\none,d\n")
    rows = files.read_samplesheet(spark, str(tmp_path / "s.csv"), "/root/x")
    assert {tuple(r) for r in rows.collect()} == {("one", "/root/x/data/a"), ("b", "/root/x/data/b/"), ("x y", "/abs/c"), ("one", "/root/x/d")}
    assert sorted(r.fault for r in files.samplesheet_faults(rows).collect()) == ["id must be unique", "id must be unique", "id must not hold spaces"]


OBO = """format-version: 1.2

[Term]
id: GO:1
namespace: molecular_function

[Term]
id: GO:2
namespace: molecular_function
is_a: GO:1 ! root

[Term]
id: GO:3
namespace: molecular_function
is_a: GO:2
is_a: GO:1

[Term]
id: GO:9
namespace: biological_process
is_a: GO:1

[Term]
id: GO:8
namespace: molecular_function
is_obsolete: true
is_a: GO:1
"""


def test_ontology(spark, tmp_path):
    (tmp_path / "go.obo").write_text(OBO)
    rows = {(r.parent, r.child): (r.level, r.depth) for r in files.read_ontology(spark, str(tmp_path / "go.obo")).collect()}
    assert rows == {("GO:1", "GO:2"): (1, 1), ("GO:2", "GO:3"): (1, 2), ("GO:1", "GO:3"): (1, 2)}


def test_predictions_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", "b", 1, 0, 0.25), ("c", "d", 0, 1, 0.5)], "domain_a string, domain_b string, true_interaction int, predicted_interaction int, predicted_probability double")
    for name in ("p.csv", "db1/rf/p.parquet"):
        sinks.write_predictions(df, str(tmp_path / name))
        back = files.read_predictions(spark, str(tmp_path / name))
        assert [f.dataType.simpleString() for f in back.schema] == ["string", "string", "tinyint", "tinyint", "float"] and back.count() == 2
    df.drop("domain_b").write.parquet(str(tmp_path / "bad"))
    with pytest.raises(ValueError, match="domain_b"):
        files.read_predictions(spark, str(tmp_path / "bad"))


def test_feature_writer_refuses_repeats(spark, tmp_path):
    row = ("d", "train", "f", "1", "2", [1.0])
    schema = "db string, split string, feature string, domain_id string, protein_id string, vec array<float>"
    with pytest.raises(ValueError, match="twice"):
        sinks.write_features(spark.createDataFrame([row, row], schema), str(tmp_path / "f"))
    sinks.write_features(spark.createDataFrame([row], schema), str(tmp_path / "f"))
    plan = spark.read.parquet(str(tmp_path / "f")).filter("feature = 'f'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(feature" in plan


def test_blocks_and_order(spark, tmp_path):
    blocks = spark.createDataFrame([("x_roc", "s", "linegraph", {"id": "x"}, "{}"), ("x_metrics_table", "s", "table", {"id": "y"}, "{}"), ("zz", "s", "table", {"id": "z"}, "{}")], "id string, section_name string, plot_type string, pconfig map<string,string>, data string")
    ids = sinks.ordered_ids(blocks)
    assert ids == ["x_metrics_table", "x_roc", "zz"] and "- x_roc" in sinks.order_yaml(ids)
    sinks.write_blocks(blocks, str(tmp_path / "b"))
    assert files.read_json(spark, str(tmp_path / "b")).count() == 3 and set(sinks.blocks_as_json(blocks)) == {"x_roc", "x_metrics_table", "zz"}
    assert sinks.provenance(spark).count() == 2
