"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from strata.plans.bound_queries import QUERIES as CORE
from tests.conftest import SF_SMALL
from tools.check_oracle import TABLES, rows_of, type_mismatches

QUERIES = {k: v for k, v in queries().items() if k in CORE}
SQL = {k: v for k, v in oracle_sql().items() if k in CORE}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["district_name", "class_name", "cal_year", "n_closed", "avg_days"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    cols = df.columns
    srows = [tuple(r) for r in df.collect()]
    rel = duck.sql(SQL[name])
    dcols = rel.columns
    drows = rel.fetchall()
    assert sorted(cols) == sorted(dcols)
    assert type_mismatches(df.dtypes, dcols, rel.types) == {}
    order = sorted(cols)
    a = rows_of([[r[cols.index(c)] for c in order] for r in srows])
    b = rows_of([[r[dcols.index(c)] for c in order] for r in drows])
    assert len(a) == len(b)
    assert a == b
