"""Every driver query with SQL, against DuckDB on the same tables."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from pointframe.plans import queries as engine

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    yield con
    con.close()


def rows(df):
    def text(v):
        if v is None or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
            return "null"
        return f"{v:.5f}" if isinstance(v, float) else str(v)

    return sorted(tuple(map(text, r)) for r in df[sorted(df.columns)].itertuples(index=False, name=None))


@pytest.mark.parametrize("name", engine.ORACLE)
def test_query_equals_sql(spark, sf, duck, name):
    got, want = engine.QUERIES[name](spark, sf).toPandas(), duck.sql(engine.ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(want) > 0 and rows(got) == rows(want)


def test_contract(spark):
    assert entry.entry(spark).count() == 10
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(engine.QUERIES) <= set(entry.queries())


def test_sample_and_distribution_fusion(spark, sf):
    sample = engine.QUERIES["random_sample"](spark, sf).collect()
    assert len({r.id for r in sample}) == 10
    fused = engine.QUERIES["fusion_dbsf"](spark, sf).collect()
    assert len(fused) == 10 and [r.score for r in fused] == sorted((r.score for r in fused), reverse=True)
