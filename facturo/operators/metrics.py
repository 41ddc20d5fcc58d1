"""Business metrics over valid sales (Q5-Q10, Q12) and keyed combine.

Money is summed exactly as decimal and turned into double once, after the
aggregate; rankings order by the exact decimal. All group-bys plan as
partial + final hash aggregation, so a country with most of the rows is
absorbed map-side. Distinct invoice counts are planned by Spark as a
two-level aggregate on (key, invoice), which spreads a hot key over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from facturo.functions import as_money_double, count_true, null_safe_ratio, percent_change, percent_of
from facturo.operators.ordering import top_k
from facturo.schema import (
    AVG_ORDER_VALUE,
    AVG_TICKET,
    CANCEL_RATE,
    CANCELLED_LINES,
    CHANGE_PCT,
    COUNTRY,
    CUSTOMER_ID,
    DESCRIPTION,
    INVOICE,
    INVOICE_COUNT,
    IS_CANCELLED,
    LINES_TOTAL,
    MONTH,
    QUANTITY,
    REVENUE,
    TOTAL_PRICE,
    YEAR,
)


def top_products_revenue(valid: DataFrame, *, key: str = DESCRIPTION, n: int = 10) -> DataFrame:
    """Q5: products with the highest revenue."""
    sums = valid.groupBy(key).agg(F.sum(TOTAL_PRICE).alias("_rev"))
    return top_k(sums, "_rev", key, n, [F.col(key), as_money_double("_rev").alias(TOTAL_PRICE)])


def top_products_units(valid: DataFrame, *, key: str = DESCRIPTION, n: int = 10) -> DataFrame:
    """Q6: products with the most units sold."""
    sums = valid.groupBy(key).agg(F.sum(QUANTITY).cast("long").alias(QUANTITY))
    return top_k(sums, QUANTITY, key, n)


def top_customers(valid: DataFrame, *, key: str = CUSTOMER_ID, n: int = 10) -> DataFrame:
    """Q7: known customers with the highest spend."""
    sums = valid.filter(F.col(key).isNotNull()).groupBy(key).agg(F.sum(TOTAL_PRICE).alias("_rev"))
    return top_k(sums, "_rev", key, n, [F.col(key), as_money_double("_rev").alias(TOTAL_PRICE)])


def country_revenue(valid: DataFrame, *, key: str = COUNTRY, n: int = 10) -> DataFrame:
    """Q8: revenue, distinct invoices and average ticket per country, top by revenue."""
    per_key = valid.groupBy(key).agg(
        F.sum(TOTAL_PRICE).alias("_rev"),
        F.countDistinct(INVOICE).cast("long").alias(INVOICE_COUNT),
    )
    return top_k(
        per_key,
        "_rev",
        key,
        n,
        [
            F.col(key),
            as_money_double("_rev").alias(REVENUE),
            F.col(INVOICE_COUNT),
            null_safe_ratio(as_money_double("_rev"), INVOICE_COUNT).alias(AVG_TICKET),
        ],
    )


def _month_order():
    return [F.col(YEAR).asc_nulls_last(), F.col(MONTH).asc_nulls_last()]


def monthly_revenue(valid: DataFrame) -> DataFrame:
    """Q9: revenue per (year, month) and change in % against the previous month present.

    The unpartitioned window runs over the month aggregate only (one row per
    month), never over raw rows.
    """
    monthly = valid.groupBy(YEAR, MONTH).agg(as_money_double(F.sum(TOTAL_PRICE)).alias(REVENUE))
    w = Window.orderBy(*_month_order())
    return monthly.select(
        YEAR, MONTH, REVENUE, percent_change(F.col(REVENUE), F.lag(REVENUE).over(w)).alias(CHANGE_PCT)
    ).orderBy(*_month_order())


def country_cancellation(
    derived: DataFrame, *, key: str = COUNTRY, min_lines: int = 30, n: int = 10
) -> DataFrame:
    """Q10: lines, cancelled lines and cancellation rate per country.

    Countries with fewer than ``min_lines`` lines are left out; top ``n`` by rate.
    Reads the derived stage (cancelled lines included).
    """
    per_key = (
        derived.groupBy(key)
        .agg(
            F.count(INVOICE).cast("long").alias(LINES_TOTAL),
            count_true(IS_CANCELLED).cast("long").alias(CANCELLED_LINES),
        )
        .filter(F.col(LINES_TOTAL) >= min_lines)
        .withColumn(CANCEL_RATE, percent_of(CANCELLED_LINES, LINES_TOTAL))
    )
    return top_k(per_key, CANCEL_RATE, key, n, [key, LINES_TOTAL, CANCELLED_LINES, CANCEL_RATE])


def aov_global(valid: DataFrame) -> DataFrame:
    """Q12: average order value over all valid sales, as a one-row DataFrame."""
    return valid.agg(
        as_money_double(F.sum(TOTAL_PRICE)).alias(REVENUE),
        F.countDistinct(INVOICE).cast("long").alias(INVOICE_COUNT),
    ).select(REVENUE, INVOICE_COUNT, null_safe_ratio(REVENUE, INVOICE_COUNT).alias(AVG_ORDER_VALUE))


def aov_monthly(valid: DataFrame) -> DataFrame:
    """Q12: average order value per (year, month)."""
    return (
        valid.groupBy(YEAR, MONTH)
        .agg(
            as_money_double(F.sum(TOTAL_PRICE)).alias("_rev"),
            F.countDistinct(INVOICE).alias("_inv"),
        )
        .select(YEAR, MONTH, null_safe_ratio("_rev", "_inv").alias(AVG_ORDER_VALUE))
        .orderBy(*_month_order())
    )


def combine_by_key(left: DataFrame, right: DataFrame, keys: list[str] | str) -> DataFrame:
    """Align two keyed results into one frame (full outer equi-join, null-safe keys).

    A key present on one side only keeps nulls for the other side's columns.
    Both inputs are expected to be aggregates (one row per key); the planner
    picks broadcast or sort-merge from their measured sizes.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    left_cols = [c for c in left.columns if c not in keys]
    right_cols = [c for c in right.columns if c not in keys]
    lk = left.select(*[F.col(k).alias(f"_l_{i}") for i, k in enumerate(keys)], *left_cols)
    rk = right.select(*[F.col(k).alias(f"_r_{i}") for i, k in enumerate(keys)], *right_cols)
    cond = None
    for i in range(len(keys)):
        c = F.col(f"_l_{i}").eqNullSafe(F.col(f"_r_{i}"))
        cond = c if cond is None else cond & c
    joined = lk.join(rk, cond, "full_outer")
    return joined.select(
        *[F.coalesce(F.col(f"_l_{i}"), F.col(f"_r_{i}")).alias(k) for i, k in enumerate(keys)],
        *left_cols,
        *right_cols,
    )


def country_revenue_and_cancellations(valid: DataFrame, derived: DataFrame) -> DataFrame:
    """Revenue of valid sales and cancelled lines per country, aligned by country."""
    revenue = valid.groupBy(COUNTRY).agg(as_money_double(F.sum(TOTAL_PRICE)).alias(REVENUE))
    cancelled = derived.groupBy(COUNTRY).agg(count_true(IS_CANCELLED).cast("long").alias(CANCELLED_LINES))
    return combine_by_key(revenue, cancelled, COUNTRY)
