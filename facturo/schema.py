"""Column names and declared schemas of the invoice-line data model."""

from __future__ import annotations

from pyspark.sql.types import (
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# Column names of the invoice-line table, as in the source data.
INVOICE = "Invoice"
STOCK_CODE = "StockCode"
DESCRIPTION = "Description"
QUANTITY = "Quantity"
INVOICE_DATE = "InvoiceDate"
PRICE = "Price"
CUSTOMER_ID = "Customer ID"
COUNTRY = "Country"

# Result column names of the original queries.
REVENUE = "Revenue"
INVOICE_COUNT = "Facturas"
AVG_TICKET = "TicketPromedio"
CHANGE_PCT = "VariacionPct"
LINES_TOTAL = "Total"
CANCELLED_LINES = "Canceladas"
CANCEL_RATE = "TasaCancelacion"
AVG_ORDER_VALUE = "AOV"

# Derived columns added by the derive step.
TOTAL_PRICE = "TotalPrice"
IS_CANCELLED = "IsCancelled"
YEAR = "Year"
MONTH = "Month"

RAW_COLUMNS = [INVOICE, STOCK_CODE, DESCRIPTION, QUANTITY, INVOICE_DATE, PRICE, CUSTOMER_ID, COUNTRY]
TEXT_COLUMNS = [INVOICE, STOCK_CODE, DESCRIPTION, INVOICE_DATE, COUNTRY]
NUMERIC_COLUMNS = [QUANTITY, PRICE, CUSTOMER_ID]

RAW_SCHEMA = StructType(
    [
        StructField(INVOICE, StringType(), True),
        StructField(STOCK_CODE, StringType(), True),
        StructField(DESCRIPTION, StringType(), True),
        StructField(QUANTITY, IntegerType(), True),
        StructField(INVOICE_DATE, StringType(), True),
        StructField(PRICE, DoubleType(), True),
        StructField(CUSTOMER_ID, DoubleType(), True),
        StructField(COUNTRY, StringType(), True),
    ]
)

# Schema of the space-separated "customer quantity" extract.
PAIRS_SCHEMA = StructType(
    [
        StructField("customer_id", LongType(), True),
        StructField("quantity", IntegerType(), True),
    ]
)

# Exact money arithmetic: quantity (an int) as decimal(10,0), price as
# decimal(21,8): below 10^13, in steps of 10^-8. Their product is
# decimal(32,8) and Spark widens sums of it to decimal(38,8).
QUANTITY_DECIMAL = DecimalType(10, 0)
PRICE_DECIMAL = DecimalType(21, 8)
