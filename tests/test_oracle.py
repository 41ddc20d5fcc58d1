"""Every registered query against its DuckDB oracle on the smallest tables."""

from __future__ import annotations

import datetime as dt
import decimal
import os

import duckdb
import pytest
from conftest import SF_SMALL

import __spark_entry__ as entry_module
from facturo.plans import catalog

TABLES = "region nation customer supplier part orders lineitem".split()


def _norm(v):
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return "<null>" if v is None else str(v)


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(cols), sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t + '.parquet')}')")
    yield con
    con.close()


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) == set(catalog.oracle_sql()) <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_oracle(spark, duck, name):
    sdf = entry_module.queries()[name](spark, SF_SMALL)
    s_cols, s_rows = _canon(sdf.columns, [tuple(r) for r in sdf.collect()])
    res = duck.execute(entry_module.oracle_sql()[name])
    d_cols, d_rows = _canon([d[0] for d in res.description], res.fetchall())
    assert s_cols == d_cols
    assert len(s_rows) == len(d_rows)
    assert s_rows == d_rows


def test_entry_smoke(spark):
    df = entry_module.entry(spark)
    rows = df.collect()
    assert df.columns == ["Description", "TotalPrice"] and len(rows) == 10
