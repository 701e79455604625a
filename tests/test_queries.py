"""Every registered query runs; those with SQL match DuckDB on the small tables."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(SF_SMALL):
        if f.endswith(".parquet"):
            c.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{SF_SMALL}/{f}')")
    return c


def _canon(df):
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if df[c].dtype == object:
            df[c] = df[c].astype(str)
    return df.sort_values(list(df.columns)).reset_index(drop=True)


SQL_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    rel = con.execute(E.oracle_sql()[name])
    sql_types = {d[0]: str(d[1]) for d in rel.description}
    assert {f.name: SQL_TYPES.get(f.dataType.simpleString()) for f in sdf.schema.fields} == sql_types
    got = _canon(sdf.toPandas())
    want = _canon(rel.df())
    assert list(got.columns) == list(want.columns)
    assert len(got) == len(want)
    pd.testing.assert_frame_equal(got, want, check_dtype=False, check_exact=True)


#: Hundreds of passes; the same trees are tested on fewer rounds in test_boost.py.
LONG = {"gbt_declared", "ngboost_minibatch"}


@pytest.mark.parametrize("name", sorted(set(E.queries()) - set(E.oracle_sql()) - LONG))
def test_rows_only_queries_run(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    assert df.count() > 0


def test_entry(spark):
    row = E.entry(spark).first()
    assert row["n"] > 0 and row["r2"] > 0.99
