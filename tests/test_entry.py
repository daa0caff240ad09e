"""Driver contract: entry runs; every query runs at sf0.001 and equals its DuckDB
oracle there (row count, column names, order-free values)."""

import importlib
import math

import duckdb
import pytest

from registrar.plans.catalog import queries
from registrar.plans.oracle import oracle_sql

E = importlib.import_module("__spark_entry__")
SMOKE = "/root/testdata/sf0.001"
VIEWS = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for v in VIEWS:
        con.execute(f"CREATE VIEW {v} AS SELECT * FROM read_parquet('{SMOKE}/{v}.parquet')")
    yield con
    con.close()


def _norm(v):
    if v is None:
        return ("~",)
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, (int, float)):
        return ("nan",) if isinstance(v, float) and math.isnan(v) else ("n", round(float(v), 6))
    if isinstance(v, (list, tuple)):
        return ("l", tuple(_norm(x) for x in v))
    return ("s", str(v))


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert set(df.columns) == {"student_id", "district", "average_grade"}
    assert df.count() > 0


def test_every_query_has_oracle_sql():
    assert set(oracle_sql()) == set(queries())
    assert set(queries()) <= set(E.queries()) and set(oracle_sql()) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_oracle(spark, duck, name):
    df = queries()[name](spark, SMOKE)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    res = duck.execute(oracle_sql()[name])
    d_cols, d_rows = [d[0] for d in res.description], res.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert _rows(s_cols, s_rows) == _rows(d_cols, d_rows)
