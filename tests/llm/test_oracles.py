"""Training-data queries against their SQL twins."""

import pytest

from colloquia.llm import queries

duckdb = pytest.importorskip("duckdb")


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "benchmark"):
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    df = queries.QUERIES[name](spark, sf_dir)
    want = con.execute(queries.ORACLES[name])
    columns = [c[0] for c in want.description]
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(tuple, df.select(*columns).collect()), key=str) == sorted(want.fetchall(), key=str)
