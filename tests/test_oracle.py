"""Every query key against its DuckDB oracle on the smallest test tables."""

import datetime as dt
import decimal
import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as E

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return 0.0 if round(v, 6) == 0 else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _canon(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted((tuple(_norm(r[i]) for i in order) for r in data), key=repr)


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def test_contract_keys():
    qs, oracle = E.queries(), E.oracle_sql()
    assert len(qs) >= 100
    assert set(oracle) <= set(qs)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "l_orderkey" in df.columns


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, sf, duck, name):
    df = E.queries()[name](spark, sf)
    rel = duck.sql(E.oracle_sql()[name])
    sc, sr = _canon(df.columns, [tuple(r) for r in df.collect()])
    oc, orr = _canon(rel.columns, rel.fetchall())
    assert sc == oc
    assert len(sr) == len(orr)
    assert sr == orr


@pytest.mark.parametrize("missing", ["public_tokenizers", "regex", "curata.llm", "corpus_pipeline"])
def test_survey_keys_stay_without_optional_modules(missing):
    """In a fresh interpreter in which an optional module cannot be imported."""
    code = f"""
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name == {missing!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Gone())
import warnings
warnings.simplefilter("ignore")
import __spark_entry__ as E
from curata.workload import QUERIES
assert set(QUERIES) <= set(E.queries()) and E.oracle_sql()
"""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code], check=True, cwd=root, timeout=120)
