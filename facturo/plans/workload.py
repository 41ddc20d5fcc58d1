"""The full workload (scan, Q1-Q4, then Q5-Q12) as one dict of lazy plans.

``Stages`` holds the chained stage views. By default they stay one lazy plan
each, so Catalyst pushes the clean and valid predicates to the scan. With
``materialize=True`` the derived stage is written once as parquet under the
shared checkpoint folder and read back: the later queries then scan columnar
files with pushdown, and a lost executor costs a re-read, not a re-run of the
dedup shuffle (a cache would be lost with the executor).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from facturo.operators import metrics, prepare, segments
from facturo.session import materialize as write_and_read
from facturo.sources.fixture import invoice_lines


@dataclass(frozen=True)
class Stages:
    raw: DataFrame
    clean: DataFrame
    dedup: DataFrame
    derived: DataFrame
    valid: DataFrame


def build_stages(raw: DataFrame) -> Stages:
    s = prepare.prepared_stages(raw)
    return Stages(raw=raw, clean=s["clean"], dedup=s["dedup"], derived=s["derived"], valid=s["valid"])


def stages_from_tables(spark: SparkSession, sf_dir: str) -> Stages:
    return build_stages(invoice_lines(spark, sf_dir))


def materialize_stages(spark: SparkSession, stages: Stages) -> Stages:
    """Write the derived stage once; valid becomes a filter over the written table."""
    derived = write_and_read(stages.derived, spark, "derived")
    return Stages(
        raw=stages.raw,
        clean=stages.clean,
        dedup=stages.dedup,
        derived=derived,
        valid=prepare.valid_rows(derived),
    )


def twelve_queries(stages: Stages) -> dict[str, DataFrame]:
    """Q1-Q12 results, each a lazy DataFrame (the original workload's twelve queries)."""
    v, d = stages.valid, stages.derived
    return {
        "q01_clean": stages.clean,
        "q02_dedup": stages.dedup,
        "q03_derive": prepare.derived_sample(d),
        "q04_valid": v,
        "q05_top_products_revenue": metrics.top_products_revenue(v),
        "q06_top_products_units": metrics.top_products_units(v),
        "q07_top_customers": metrics.top_customers(v),
        "q08_country_revenue": metrics.country_revenue(v),
        "q09_monthly_revenue": metrics.monthly_revenue(v),
        "q10_country_cancellation": metrics.country_cancellation(d),
        "q11_tier_counts": segments.tier_counts(v),
        "q12_aov_global": metrics.aov_global(v),
        "q12_aov_monthly": metrics.aov_monthly(v),
    }
