"""Every catalogue query against its DuckDB SQL at sf0.001, and the driver entry."""

import duckdb
import pytest

import __spark_entry__ as E
from tools.oracle_check import TABLES, rows_of

from conftest import SF_SMALL

SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "r" in df.columns


def test_every_query_has_sql():
    from barflow.plans.registry import load_all
    assert set(load_all()) <= set(SQL)  # the optional subpackage tests its own


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF_SMALL).toPandas()
    ddf = con.execute(SQL[name]).df()
    assert sorted(sdf.columns) == sorted(ddf.columns)
    cols = sorted(sdf.columns)
    assert rows_of(sdf, cols) == rows_of(ddf, cols)
