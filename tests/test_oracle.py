"""Every registered query against its DuckDB oracle on sf0.001."""
import datetime as dt
import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from streamfold.plans import catalog

SF = "/root/testdata/sf0.001"
NAMES = sorted(catalog.QUERIES)


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.6g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, bool):
        return int(v)
    return v


def _key(r):
    return tuple((x is None, type(x).__name__ if x is not None else "", x if x is not None else 0) for x in r)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(SF):
        if f.endswith(".parquet"):
            c.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{SF}/{f}')")
    return c


def test_every_query_has_oracle():
    assert set(E.oracle_sql()) & set(catalog.QUERIES) == set(NAMES)
    assert set(catalog.QUERIES) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and df.columns[0] == "symbol"


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    got = [tuple(_norm(v) for v in r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    idx = [ocols.index(c) for c in df.columns]
    exp = [tuple(_norm(r[i]) for i in idx) for r in res.fetchall()]
    assert sorted(got, key=_key) == sorted(exp, key=_key)
