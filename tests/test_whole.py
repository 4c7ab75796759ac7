"""Queries and null models over whole tables: nothing is capped, filtered by number or folded."""

import itertools
import random

import numpy as np
import pytest

from weftline.operators import nullmodels
from weftline.plans import workloads
from weftline.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"


def test_set_cover_lp_takes_every_pair_and_run(spark, monkeypatch):
    seen = {}
    whole = nullmodels.observed_cover
    monkeypatch.setattr(nullmodels, "observed_cover", lambda *a, **k: seen.update(k, pairs=a[2].count()) or whole(*a, **k))
    got = QUERIES["set_cover_lp"](spark, SF).toPandas()
    known = workloads.ddi(spark, SF).select("domain_a", "domain_b").distinct().count()
    assert known > 150 and seen == {"pairs": known}
    assert got.groupby("reliability").pair_id.nunique().to_dict() == {0.5: known, 1.0: known} and not got.x.isna().any()


def test_assemble_matrix_whole_equals_brute_force(spark):
    got = {tuple(r)[:5]: r.x for r in QUERIES["assemble_matrix_whole"](spark, SF).collect()}
    pairs = {tuple(r) for r in workloads.ddi(spark, SF).select("domain_a", "domain_b", "interaction").collect()}
    vectors = {(r.domain_id, r.protein_id): r.embedding for r in workloads.vecs(spark, SF).collect() if r.vec_id % 3}
    proteins = {}
    for domain, protein in vectors:
        proteins.setdefault(domain, []).append(protein)
    want = {(x, y, p, q, l) for a, b, l in pairs for x, y in ((a, b), (b, a)) for p in proteins.get(x, ()) for q in proteins.get(y, ())}
    # 64 and 8 numbers of a, then those of b: the 80th is b's 8th
    assert got.keys() == want and all(got[k] == pytest.approx(vectors[k[1], k[3]][7], abs=1e-5) for k in want)
    assert {p for k in got for p in k[2:4]} == {p for ps in proteins.values() for p in ps} > {"P0", "P1", "P2", "P3"}


def test_components_whole_equals_brute_force(spark):
    keys = [r[0] for r in spark.read.parquet(f"{SF}/customer.parquet").select("c_custkey").collect()]
    root = {k: k for k in [*keys, *(k * 3 % (max(keys) + 1) for k in keys)]}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for k in keys:
        a, b = sorted((find(k), find(k * 3 % (max(keys) + 1))))
        root[b] = a
    got = {r.node: r.component for r in QUERIES["components_whole"](spark, SF).collect()}
    assert got == {k: find(k) for k in root} and set(keys) <= got.keys()
