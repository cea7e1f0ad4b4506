import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from tools.oracle_check import TABLES, _rows

from .conftest import SF01


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and df.columns == ["n", "accuracy", "precision", "recall", "loss"]
    assert rows[0].n == 500 and 0 <= rows[0].accuracy <= 1


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF01}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_duckdb(spark, duck, name):
    sp = E.queries()[name](spark, SF01).toPandas()
    dd = duck.sql(E.oracle_sql()[name]).df()
    assert sorted(sp.columns) == sorted(dd.columns)
    assert len(sp) == len(dd)
    assert _rows(sp) == _rows(dd)


def test_public_api_imports():
    import headstart

    missing = [n for n in headstart.__all__ if not hasattr(headstart, n)]
    assert not missing


@pytest.mark.parametrize("name", ["fit_history", "fit_warm_start"])
def test_rows_only_queries_are_deterministic(spark, name):
    q = E.queries()[name]
    a = sorted(map(tuple, q(spark, SF01).collect()))
    b = sorted(map(tuple, q(spark, SF01).collect()))
    assert a == b and len(a) == 4
