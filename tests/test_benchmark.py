import sqlite3

import pytest

from weftline.operators.graph_models import ParsimonyConfig
from weftline.plans.benchmark import Options, run
from weftline.sources.cache import kept

def make(path, seed):
    with sqlite3.connect(path) as c:
        c.execute("CREATE TABLE domain (id INTEGER PRIMARY KEY, pfam_id TEXT)")
        c.execute("CREATE TABLE protein (id INTEGER PRIMARY KEY, uniprot_id TEXT)")
        c.execute("CREATE TABLE domain_protein_map (domain_id INTEGER, protein_id INTEGER, domain_sequence TEXT, start_pos INT, end_pos INT)")
        c.execute("CREATE TABLE domain_domain_interaction (domain_id_a INTEGER, domain_id_b INTEGER, negative BOOLEAN, is_evaluation_relevant BOOLEAN)")
        c.execute("CREATE TABLE protein_protein_interaction (protein_id_a INTEGER, protein_id_b INTEGER, score INT)")
        c.execute("CREATE TABLE protein_go_terms (protein_id INTEGER, go_accession TEXT)")
        c.executemany("INSERT INTO domain VALUES (?, ?)", [(k, f"PF{k:03d}") for k in range(8)])
        c.executemany("INSERT INTO protein VALUES (?, ?)", [(k, f"U{k}") for k in range(10)])
        c.executemany("INSERT INTO domain_protein_map VALUES (?, ?, ?, 0, 3)", [((k * j + seed) % 8, k, ("ACD" if (k * j + seed) % 2 else "KRW") * (k + 1)) for k in range(10) for j in (1, 3) if j == 1 or (k * 3 + seed) % 8 != (k + seed) % 8])
        c.executemany("INSERT INTO domain_domain_interaction VALUES (?, ?, ?, 1)", [(a, b, int(a % 2 != b % 2)) for a in range(8) for b in range(a, 8)])
        c.executemany("INSERT INTO protein_protein_interaction VALUES (?, ?, ?)", [(a, b, 950) for a in range(10) for b in range(a + 1, 10) if (a * b + seed) % 3])
        c.executemany("INSERT INTO protein_go_terms VALUES (?, ?)", [(k, f"GO:{2 + k % 3}") for k in range(10)])


def test_sample_sheet_to_report(spark, tmp_path):
    (tmp_path / "db").mkdir()
    for k, s in enumerate(("train", "test", "optimization")):
        make(tmp_path / "db" / f"{s}.sqlite3", k)
    (tmp_path / "sheet.csv").write_text("id,db_path\nd1,db\n")
    options = Options(
        ["aacomp"], ["random_forest"], {"random_forest": {"space": {"n_estimators": [3], "max_depth": [3]}}},
        {"parsimony": ParsimonyConfig(iterations=4, runs=2, optimized=(0.5, 0.7))}, bootstrap=20,
    )
    found = {r.model: r for r in run(spark, str(tmp_path / "sheet.csv"), str(tmp_path / "out"), options, str(tmp_path)).collect()}
    assert set(found) == {"random_forest_aacomp", "parsimony"} and found["random_forest_aacomp"].roc_auc > 0.6
    blocks = spark.read.json(str(tmp_path / "out/report/d1"))
    assert {r.id for r in blocks.select("id").collect()} == {f"{b}_d1" for b in ("metrics_table", "roc", "pr", "metrics_overview", "pairwise_significance", "database_analysis")}
    (tmp_path / "bad.csv").write_text("id,db_path\na b,x\n")
    with pytest.raises(ValueError, match="spaces"):
        run(spark, str(tmp_path / "bad.csv"), str(tmp_path / "o2"), options)


def test_kept_tables(spark, tmp_path):
    made = []
    make_it = lambda: made.append(1) or spark.range(5)
    for rows in (5, 5, 6):
        kept(spark, str(tmp_path), "k", rows, make_it).count()
    assert len(made) == 2
