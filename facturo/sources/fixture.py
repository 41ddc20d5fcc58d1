"""Invoice lines built from the TPC-H-like driver tables.

The driver tables hold no nulls and no duplicates, so the mapping below adds
the dirt the operators have to handle: cancellations, missing descriptions,
zero prices, unknown customers, returns and exact duplicate rows.

Plan shape: the customer's nation key is attached to each order first
(orders x customer), so the widest input, lineitem, is shuffled once by order
key and once by part key, carrying only narrow columns; the country name comes
last from nation, a fixed 25-row dimension that is broadcast. Only the columns
the mapping needs leave each scan. Duplicates are produced with a generator
after the last join, so the joined rows are computed once.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType

from facturo.schema import (
    COUNTRY,
    CUSTOMER_ID,
    DESCRIPTION,
    INVOICE,
    INVOICE_DATE,
    PRICE,
    QUANTITY,
    RAW_COLUMNS,
    STOCK_CODE,
)

# The dirt rules of the fixture mapping (all on integer keys).
CANCEL_ORDER_MOD, CANCEL_ORDER_REM = 50, 7          # o_orderkey % 50 = 7 -> "C" invoice, negated quantity
RETURN_ORDER_MOD, RETURN_ORDER_REM = 300, 1         # l_orderkey % 300 = 1 -> negated quantity
NULL_DESC_PART_MOD, NULL_DESC_PART_REM = 250, 0     # l_partkey % 250 = 0 -> null description
ZERO_PRICE_PART_MOD, ZERO_PRICE_PART_REM = 200, 1   # l_partkey % 200 = 1 -> price 0.0
NULL_CUST_MOD, NULL_CUST_BELOW = 9, 2               # o_custkey % 9 < 2 -> null customer
DUP_LINE_NUMBER = 1                                 # l_linenumber = 1 and
DUP_ORDER_MOD, DUP_ORDER_REM = 30, 0                # l_orderkey % 30 = 0 -> row appears twice

# Driver tables the mapping reads.
FIXTURE_TABLES = ("lineitem", "orders", "customer", "nation", "part")


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def invoice_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 8-column invoice-line table (raw, with dirt) from the driver tables."""
    lineitem = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity"
    )
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")

    # Orders carry the 4-byte nation key through the two lineitem-sized
    # shuffles; the country name is attached at the very end from the
    # broadcast 25-row nation table, a map-side join.
    order_nation = orders.join(customer, orders.o_custkey == customer.c_custkey, "inner").select(
        "o_orderkey", "o_custkey", "o_orderdate", "c_nationkey"
    )

    copies = F.when(
        (F.col("l_linenumber") == DUP_LINE_NUMBER)
        & (F.col("l_orderkey") % DUP_ORDER_MOD == DUP_ORDER_REM),
        F.lit(2),
    ).otherwise(F.lit(1))
    lines = lineitem.select(
        "l_orderkey", "l_partkey", "l_quantity", copies.cast("tinyint").alias("_copies")
    )

    joined = (
        lines.join(order_nation, lines.l_orderkey == order_nation.o_orderkey, "inner")
        .join(part, F.col("l_partkey") == part.p_partkey, "inner")
        .join(F.broadcast(nation), F.col("c_nationkey") == nation.n_nationkey, "inner")
    )

    cancelled = F.col("o_orderkey") % CANCEL_ORDER_MOD == CANCEL_ORDER_REM
    negated = cancelled | (F.col("l_orderkey") % RETURN_ORDER_MOD == RETURN_ORDER_REM)
    order_text = F.col("o_orderkey").cast(StringType())
    quantity = F.col("l_quantity").cast(IntegerType())

    mapped = joined.select(
        F.when(cancelled, F.concat(F.lit("C"), order_text)).otherwise(order_text).alias(INVOICE),
        F.concat(F.lit("P"), F.col("l_partkey").cast(StringType())).alias(STOCK_CODE),
        F.when(F.col("l_partkey") % NULL_DESC_PART_MOD == NULL_DESC_PART_REM, F.lit(None).cast(StringType()))
        .otherwise(F.col("p_name"))
        .alias(DESCRIPTION),
        F.when(negated, -quantity).otherwise(quantity).alias(QUANTITY),
        F.col("o_orderdate").cast(StringType()).alias(INVOICE_DATE),
        F.when(F.col("l_partkey") % ZERO_PRICE_PART_MOD == ZERO_PRICE_PART_REM, F.lit(0.0))
        .otherwise(F.col("p_retailprice"))
        .cast(DoubleType())
        .alias(PRICE),
        F.when(F.col("o_custkey") % NULL_CUST_MOD < NULL_CUST_BELOW, F.lit(None).cast(DoubleType()))
        .otherwise(F.col("o_custkey").cast(DoubleType()))
        .alias(CUSTOMER_ID),
        F.col("n_name").alias(COUNTRY),
        F.col("_copies"),
    )
    return mapped.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))).select(
        *RAW_COLUMNS
    )


# The same mapping as SQL, for the DuckDB oracle (CTEs ``fx`` and ``raw``).
_RAW_SQL_COLUMNS = ', '.join(f'"{c}"' for c in RAW_COLUMNS)
RAW_SQL = f"""
fx AS (
  SELECT
    CASE WHEN o.o_orderkey % {CANCEL_ORDER_MOD} = {CANCEL_ORDER_REM}
         THEN 'C' || CAST(o.o_orderkey AS VARCHAR) ELSE CAST(o.o_orderkey AS VARCHAR) END AS "Invoice",
    'P' || CAST(l.l_partkey AS VARCHAR) AS "StockCode",
    CASE WHEN l.l_partkey % {NULL_DESC_PART_MOD} = {NULL_DESC_PART_REM} THEN NULL ELSE p.p_name END AS "Description",
    CASE WHEN o.o_orderkey % {CANCEL_ORDER_MOD} = {CANCEL_ORDER_REM} OR l.l_orderkey % {RETURN_ORDER_MOD} = {RETURN_ORDER_REM}
         THEN -CAST(l.l_quantity AS INTEGER) ELSE CAST(l.l_quantity AS INTEGER) END AS "Quantity",
    CAST(o.o_orderdate AS VARCHAR) AS "InvoiceDate",
    CAST(CASE WHEN l.l_partkey % {ZERO_PRICE_PART_MOD} = {ZERO_PRICE_PART_REM} THEN 0.0 ELSE p.p_retailprice END AS DOUBLE) AS "Price",
    CASE WHEN o.o_custkey % {NULL_CUST_MOD} < {NULL_CUST_BELOW} THEN NULL ELSE CAST(o.o_custkey AS DOUBLE) END AS "Customer ID",
    n.n_name AS "Country",
    (l.l_linenumber = {DUP_LINE_NUMBER} AND l.l_orderkey % {DUP_ORDER_MOD} = {DUP_ORDER_REM}) AS dup
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN part p ON l.l_partkey = p.p_partkey
),
raw AS (
  SELECT {_RAW_SQL_COLUMNS} FROM fx
  UNION ALL
  SELECT {_RAW_SQL_COLUMNS} FROM fx WHERE dup
)"""
