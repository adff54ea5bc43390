"""Every query with SQL gives the rows that DuckDB gives on the same tables."""

import os

import duckdb
import numpy as np
import pandas as pd
import pytest

from notara import queries as notes

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(x):
    if isinstance(x, (np.ndarray, list, tuple)):
        return [plain(y) for y in x]
    if x is None or x is pd.NaT or x is pd.NA or isinstance(x, float) and x != x:
        return None
    return x.item() if isinstance(x, np.generic) else x


def rows(df):
    df = df[sorted(df.columns)]
    return sorted(repr([plain(x) for x in r]) for r in df.astype(object).itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")
@pytest.mark.parametrize("name", sorted(notes.ORACLES))
def test_same_rows(spark, duck, name):
    got = notes.QUERIES[name](spark, SF).toPandas()
    want = duck.sql(notes.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
