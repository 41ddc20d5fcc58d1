"""Lazy DataFrame operators over invoice lines. None of them takes an action."""

from facturo.operators.metrics import (
    aov_global,
    aov_monthly,
    combine_by_key,
    country_cancellation,
    country_revenue,
    country_revenue_and_cancellations,
    monthly_revenue,
    top_customers,
    top_products_revenue,
    top_products_units,
)
from facturo.operators.ordering import secondary_sort, top_k
from facturo.operators.prepare import (
    clean_rows,
    dedup_rows,
    derive_columns,
    derived_sample,
    prepared_stages,
    stage_counts,
    valid_rows,
)
from facturo.operators.profile import (
    country_counts,
    duplicate_rows,
    gross_revenue,
    mean_invoice_value,
    monthly_line_counts,
    profile_cancelled,
    profile_cardinality,
    profile_duplicates,
    profile_invalid,
    profile_nulls,
    profile_numeric,
    profile_numeric_all,
    profile_schema,
    profile_text,
    raw_top_customers,
    raw_top_products,
    time_range,
)
from facturo.operators.quantiles import exact_quantiles, order_statistics, rank_intervals
from facturo.operators.segments import customer_spend, customer_tiers, tier_counts, tier_cuts
from facturo.operators.text import (
    customer_quantity_pairs,
    customer_quantity_sorted,
    description_lines,
    word_length_hist,
    word_mean,
    word_median,
    words,
)

__all__ = [name for name in dir() if not name.startswith("_")]
