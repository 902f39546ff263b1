"""Every registered reference-side query against its SQL twin in DuckDB."""

import math

import pytest

from colloquia.plans import catalogue

duckdb = pytest.importorskip("duckdb")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def engine(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def norm(v):
    return round(v, 9) if isinstance(v, float) and math.isfinite(v) else v


@pytest.mark.parametrize("name", list(catalogue.ORACLES))
def test_query(spark, engine, sf_dir, name):
    df = catalogue.QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    have = sorted((tuple(map(norm, r)) for r in df.select(*columns).collect()), key=str)
    want = engine.execute(catalogue.ORACLES[name])
    names = [c[0] for c in want.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert have == sorted((tuple(norm(r[i]) for i in at) for r in want.fetchall()), key=str)
    assert have


def test_streaming_equals_batch(spark, sf_dir):
    batch = sorted(map(tuple, catalogue.QUERIES["blind_accuracy"](spark, sf_dir).select("qid", "correct_count", "total_count", "result").collect()))
    stream = catalogue.QUERIES["running_blind_accuracy"](spark, sf_dir).select("qid", "correct_count", "total_count", "result")
    assert sorted(map(tuple, stream.collect())) == batch
