"""Every registered query against its DuckDB oracle on the smallest test tables."""

import math
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from icuflow.sources.tables import TABLES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test tables not present")


def _norm(df):
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        df[c] = df[c].map(lambda v: None if v is None or (isinstance(v, float) and math.isnan(v)) else
                          (round(float(v), 6) if isinstance(v, float) else
                           (str(pd.Timestamp(v)) if hasattr(v, "year") else str(v))))
    return df.astype(str).sort_values(list(df.columns)).reset_index(drop=True)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    got = E.queries()[name](spark, SF).toPandas()
    want = con.execute(E.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert _norm(got).equals(_norm(want))


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and df.columns[0] == "hadm_id"
