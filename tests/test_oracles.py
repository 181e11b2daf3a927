"""Every registered SQL-checkable query equals its DuckDB oracle on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from lodgeframe.sources.fixtures import TABLES

from conftest import SF_SMALL

# Fitted by MLlib solvers without a closed form; tests/test_model.py checks them.
MODEL_QUERIES = {"als_grid", "als_recommend"}
SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "float": "FLOAT",
                 "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE"}


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    return repr(v)


def _bag(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _bag(rows, df.columns) == _bag(res.fetchall(), ocols)
    duck_types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {E.oracle_sql()[name]}").fetchall()}
    assert {n: SPARK_TO_DUCK.get(t, t.upper()) for n, t in df.dtypes} == duck_types


def test_every_query_has_an_oracle_or_a_test():
    from lodgeframe.plans.oracle import oracle_sql
    from lodgeframe.plans.queries import QUERIES
    free = set(QUERIES) - set(oracle_sql()) - MODEL_QUERIES
    assert not free


def test_model_queries_agree(spark):
    """The error query is the error of the predict query; both cover the held-out listings."""
    pred = E.queries()["price_glm_predict"](spark, SF_SMALL).collect()
    rmse = E.queries()["price_glm_rmse"](spark, SF_SMALL).first()["rmse"]
    err = math.sqrt(sum((r["label"] - r["prediction"]) ** 2 for r in pred) / len(pred))
    assert err == pytest.approx(rmse, rel=1e-5)
    held = spark.read.parquet(f"{SF_SMALL}/part.parquet").where(
        "pmod(pmod(p_partkey, 100) * 48271 + 5, 100) >= 80").count()
    assert len({r["id"] for r in pred}) == len(pred) == held
    best = E.queries()["price_glm_profit"](spark, SF_SMALL).collect()
    assert {r["host_id"] for r in best} == {r["id"] for r in pred}
    for r in best:
        assert r["profit"] == pytest.approx(r["price"] * r["future_occupancy"] * 30)


def test_entry_smoke(spark):
    df = E.entry(spark)
    parts = spark.read.parquet(f"{SF_SMALL}/part.parquet").count()
    assert df.columns[0] == "id" and df.count() == parts
