"""Every reference query against its SQL, and the driver's contract."""

import glob
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from weftline.plans import extended  # noqa: F401
from weftline.plans.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


def rows(df):
    def cell(x):
        if pd.isna(x):
            return None
        return round(float(x), 4) + 0.0 if isinstance(x, float) or hasattr(x, "dtype") and x.dtype.kind == "f" else x if isinstance(x, str) else int(x)

    names = sorted(df.columns)
    return names, sorted((tuple(cell(x) for x in r) for r in df[names].itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    got = QUERIES[name](spark, SF).toPandas()
    if name in ORACLES:
        assert rows(got) == rows(db.sql(ORACLES[name]).df())
    else:
        assert len(got.columns)


def test_contract(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries()) and entry.entry(spark).count() > 0
