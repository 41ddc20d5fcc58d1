"""Skewed input: one customer, country and product with about a third of the
rows, plus one group of identical copies about as large. Every query must
still equal its DuckDB oracle on the same file."""

from __future__ import annotations

import datetime as dt
import decimal
import glob

import duckdb
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from facturo.plans import catalog
from facturo.schema import RAW_COLUMNS
from facturo.session import scratch_path
from facturo.sources.fixture import invoice_lines

HOT_ROWS = 3000


def _norm(v):
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return "<null>" if v is None else str(v)


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(cols), sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def skewed(spark):
    base = invoice_lines(spark, SF_SMALL)
    ids = spark.range(HOT_ROWS)
    hot = ids.select(
        F.concat(F.lit("H"), (F.col("id") % 700).cast("string")).alias("Invoice"),
        F.concat(F.lit("P"), (F.col("id") % 13).cast("string")).alias("StockCode"),
        F.lit("hot item").alias("Description"),
        ((F.col("id") % 41) - 3).cast("int").alias("Quantity"),
        F.concat(F.lit("1996-0"), (F.col("id") % 9 + 1).cast("string"), F.lit("-15 00:00:00")).alias("InvoiceDate"),
        (F.lit(1.5) + (F.col("id") % 5)).cast("double").alias("Price"),
        F.lit(424242.0).alias("Customer ID"),
        F.lit("HOTLAND").alias("Country"),
    )
    copies = ids.select(
        F.lit("777").alias("Invoice"),
        F.lit("P7").alias("StockCode"),
        F.lit("copied item").alias("Description"),
        F.lit(2).cast("int").alias("Quantity"),
        F.lit("1997-03-03 00:00:00").alias("InvoiceDate"),
        F.lit(3.25).alias("Price"),
        F.lit(99.0).alias("Customer ID"),
        F.lit("COPYLAND").alias("Country"),
    )
    path = scratch_path(spark, "skewed-raw")
    base.unionByName(hot).unionByName(copies).select(*RAW_COLUMNS).write.parquet(path)
    return path


@pytest.mark.parametrize("name", sorted(catalog.raw_queries()))
def test_query_matches_oracle_under_skew(spark, skewed, name):
    raw = spark.read.parquet(skewed)
    sdf = catalog.raw_queries()[name](spark, raw)
    s_cols, s_rows = _canon(sdf.columns, [tuple(r) for r in sdf.collect()])
    files = glob.glob(f"{skewed}/*.parquet")
    file_list = ", ".join(f"'{f}'" for f in files)
    sql = catalog.oracle_sql(raw_ctes=f"raw AS (SELECT * FROM read_parquet([{file_list}]))")[name]
    con = duckdb.connect()
    res = con.execute(sql)
    d_cols, d_rows = _canon([d[0] for d in res.description], res.fetchall())
    assert s_cols == d_cols
    assert len(s_rows) == len(d_rows)
    assert s_rows == d_rows
