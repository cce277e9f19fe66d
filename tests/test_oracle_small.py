"""Every registered query against its DuckDB oracle on the smallest scale factor."""

import datetime as dt
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as entry

from conftest import SF_SMALL

from dimweave.plans.catalog import ORACLES, QUERIES as REGISTERED

# the keys of the dimension library; the optional subpackage has tests of its own
QUERIES = {k: q for k, q in entry.queries().items() if k in REGISTERED}


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    if isinstance(v, decimal.Decimal):
        return repr(round(float(v), 9))
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("events",):
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert len(QUERIES) >= 60


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, key):
    df = QUERIES[key](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    rel = duck.sql(ORACLES[key])
    assert sorted(rel.columns) == cols
    idx = [rel.columns.index(c) for c in cols]
    want = sorted((tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()), key=repr)
    assert got == want


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "checksum" in df.columns
