"""Every registered query against its DuckDB statement, at sf0.001."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from oracle_check import TABLES, rows_of  # noqa: E402

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from roasty.plans.catalog import ORACLE, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0 and "roas" in df.columns


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(queries()) and set(ORACLE) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    srows, scols = df.collect(), df.columns
    res = con.execute(ORACLE[name])
    dcols = [d[0] for d in res.description]
    assert sorted(scols) == sorted(dcols)
    assert rows_of(scols, srows) == rows_of(dcols, res.fetchall())
