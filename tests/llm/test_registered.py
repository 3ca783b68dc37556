import os

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from strata.llm.queries import SQL
from tests.llm.cases import SF


def test_every_operator_and_the_pipeline_are_registered():
    names = queries()
    assert "pipeline" in names
    for n in range(1, 14):
        assert len([q for q in names if q.startswith(f"op{n}_")]) == 1


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "labels", "conversations"):
        path = f"{SF}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"create view {t} as select * from read_parquet('{path}')")
    rel = con.sql(oracle_sql()[name])
    cols = rel.columns
    df = queries()[name](spark, SF)
    assert sorted(cols) == sorted(df.columns)
    order = sorted(cols)
    want = sorted(str([r[cols.index(c)] for c in order]) for r in rel.fetchall())
    assert sorted(str([r[c] for c in order]) for r in df.collect()) == want and want
