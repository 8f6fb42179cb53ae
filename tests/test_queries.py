"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False)), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_against_oracle(spark, duck, name):
    got = E.queries()[name](spark, SF).toPandas()
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert len(got) > 0
        return
    want = duck.sql(sql).df()
    assert _rows(got) == _rows(want)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["Genre", "NumberOfSongs", "Popularity", "Danceability", "Energy",
                          "Valence", "Loudness", "year", "month", "day"]
    assert df.count() > 0
