"""Every registered query against its DuckDB oracle at sf0.001."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from landfall.queries import QUERIES  # noqa: E402
from compare import TABLES, digest, type_mismatches  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_oracle():
    assert set(QUERIES) <= set(E.oracle_sql()) & set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    s_rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    d_cols = [c[0] for c in res.description]
    d_rows = [tuple(r) for r in res.fetchall()]
    assert sorted(df.columns) == sorted(d_cols)
    assert not type_mismatches(df, res)
    assert len(s_rows) == len(d_rows)
    assert digest(df.columns, s_rows)[0] == digest(d_cols, d_rows)[0]


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() == 128 and "flag" in df.columns
