"""Cleaning, exact deduplication, derived columns and the valid-sales filter.

Without a cache in between, Catalyst merges the clean and valid predicates into
one filter right above the scan (below the dedup aggregate), so each stage is
a cheap view of the same plan rather than a separate pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facturo.functions import as_money_double, is_cancelled, line_total, parse_timestamp, without_total
from facturo.schema import (
    DESCRIPTION,
    INVOICE,
    INVOICE_DATE,
    IS_CANCELLED,
    MONTH,
    PRICE,
    QUANTITY,
    TOTAL_PRICE,
    YEAR,
)


def clean_predicate(description: str = DESCRIPTION, price: str = PRICE):
    return F.col(description).isNotNull() & (F.col(price) > 0)


def clean_rows(df: DataFrame, *, description: str = DESCRIPTION, price: str = PRICE) -> DataFrame:
    """Q1: keep rows with a description and a positive price."""
    return df.filter(clean_predicate(description, price))


def dedup_rows(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Q2: exact duplicates removed (nulls compare equal).

    A hash aggregate on all columns: partial dedup inside each task first, so
    a huge group of copies collapses before the shuffle.
    """
    return df.dropDuplicates(subset) if subset else df.dropDuplicates()


def derive_columns(
    df: DataFrame,
    *,
    invoice: str = INVOICE,
    date: str = INVOICE_DATE,
    quantity: str = QUANTITY,
    price: str = PRICE,
) -> DataFrame:
    """Q3: parsed timestamp, exact line total, cancellation flag, year, month."""
    ts = parse_timestamp(date)
    return df.withColumns(
        {
            date: ts,
            TOTAL_PRICE: line_total(quantity, price),
            IS_CANCELLED: is_cancelled(invoice),
            YEAR: F.year(ts),
            MONTH: F.month(ts),
        }
    )


def sale_predicate(quantity: str = QUANTITY, price: str = PRICE, cancelled: str = IS_CANCELLED):
    return (F.col(quantity) > 0) & (F.col(price) > 0) & ~F.col(cancelled)


def valid_predicate(
    quantity: str = QUANTITY, price: str = PRICE, cancelled: str = IS_CANCELLED, total: str = TOTAL_PRICE
):
    return sale_predicate(quantity, price, cancelled) & F.col(total).isNotNull()


def valid_rows(
    df: DataFrame,
    *,
    quantity: str = QUANTITY,
    price: str = PRICE,
    cancelled: str = IS_CANCELLED,
    total: str = TOTAL_PRICE,
) -> DataFrame:
    """Q4: positive quantity and price, not cancelled (a null flag drops the row).

    A line whose total can't be held exactly is no valid sale either: it
    would count as an invoice without revenue. ``money_rejects`` reports such lines.
    """
    return df.filter(valid_predicate(quantity, price, cancelled, total))


def money_rejects(
    derived: DataFrame, *, quantity: str = QUANTITY, price: str = PRICE, cancelled: str = IS_CANCELLED, total: str = TOTAL_PRICE
) -> DataFrame:
    """Sales by sign, those of them without an exact total, and the exact revenue of the others: one row."""
    sale = sale_predicate(quantity, price, cancelled)
    return derived.agg(
        F.count_if(sale).cast("long").alias("sales"),
        F.count_if(sale & without_total(quantity, price)).cast("long").alias("rejected"),
        as_money_double(F.sum(F.when(sale, F.col(total)))).alias("revenue"),
    )


def prepared_stages(raw: DataFrame) -> dict[str, DataFrame]:
    """The four chained stages: clean, dedup, derived, valid."""
    clean = clean_rows(raw)
    dedup = dedup_rows(clean)
    derived = derive_columns(dedup)
    valid = valid_rows(derived)
    return {"clean": clean, "dedup": dedup, "derived": derived, "valid": valid}


def stage_counts(raw: DataFrame, *, invoice: str = INVOICE, quantity: str = QUANTITY, price: str = PRICE) -> DataFrame:
    """Row counts of raw, clean, dedup and valid stages (and rows removed by
    cleaning and by deduplication) from one grouped pass.

    Dedup keys are whole rows, so clean and valid are constant inside a group:
    raw = sum(n), clean = sum(n) over clean groups, dedup = clean groups,
    valid = clean groups that are valid. One shuffle instead of four scans.
    """
    cols = raw.columns
    groups = raw.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    is_clean = clean_predicate(price=price)
    is_valid = is_clean & (F.col(quantity) > 0) & ~is_cancelled(invoice) & line_total(quantity, price).isNotNull()
    counts = groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("rows_raw"),
        F.coalesce(F.sum(F.when(is_clean, F.col("_n")).otherwise(F.lit(0))), F.lit(0)).cast("long").alias("rows_clean"),
        F.count_if(is_clean).cast("long").alias("rows_dedup"),
        F.count_if(is_valid).cast("long").alias("rows_valid"),
    )
    return counts.withColumns(
        {
            "removed_clean": F.col("rows_raw") - F.col("rows_clean"),
            "removed_duplicates": F.col("rows_clean") - F.col("rows_dedup"),
        }
    )


def derived_sample(derived: DataFrame, n: int = 5) -> DataFrame:
    """First ``n`` rows of the derived key columns in a total order."""
    cols = [INVOICE, TOTAL_PRICE, IS_CANCELLED, YEAR, MONTH]
    return derived.select(*cols).orderBy(*[F.col(c).asc_nulls_last() for c in cols]).limit(n)
