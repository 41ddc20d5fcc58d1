"""Row counts and one-row profiles observed while the stages are written, without scans of their own.

The raw table and the derived table are written once anyway. ``DataFrame.observe``
adds aggregates to those two writes. Only the last stage of each write is
observed (raw: the scan; derived: after the dedup shuffle): Spark counts a task
of a last stage once, however often it runs, whereas a map task that runs again
after an executor is lost would be counted twice. That is why the clean rows
are counted on the raw write, as rows that pass the clean predicate.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from facturo.functions import line_total, parse_timestamp, rounded_percent
from facturo.operators import prepare
from facturo.plans.workload import Stages, build_stages
from facturo.schema import INVOICE_DATE, PRICE, QUANTITY
from facturo.session import materialize


def _raw_measures(raw: DataFrame) -> list[Column]:
    time = parse_timestamp(INVOICE_DATE)
    return [
        F.count(F.lit(1)).alias("rows"),
        F.count_if(prepare.clean_predicate()).alias("rows_clean"),
        *[F.count(F.col(f"`{c}`")).alias(f"filled_{i}") for i, c in enumerate(raw.columns)],
        F.count_if(F.col(QUANTITY) < 0).alias("negative_quantity"),
        F.count_if(F.col(PRICE) <= 0).alias("non_positive_price"),
        F.min(time).alias("first_time"),
        F.max(time).alias("last_time"),
        F.sum(F.when(F.col(QUANTITY) > 0, line_total(QUANTITY, PRICE))).cast("double").alias("gross_revenue"),
    ]


def _derived_measures() -> list[Column]:
    sale = prepare.sale_predicate()
    return [
        F.count(F.lit(1)).alias("rows_dedup"),
        F.count_if(prepare.valid_predicate()).alias("rows_valid"),
        F.count_if(sale).alias("sales"),
        F.count_if(sale & ~prepare.valid_predicate()).alias("rejected"),
        F.sum(F.when(prepare.valid_predicate(), F.col("TotalPrice"))).cast("double").alias("revenue"),
    ]


def _written(df: DataFrame, spark: SparkSession, name: str, measures: list[Column]) -> tuple[DataFrame, dict[str, Any]]:
    seen = Observation(name)
    table = materialize(df.observe(seen, *measures), spark, name)
    return table, seen.get


@dataclass(frozen=True)
class Observed:
    """Stages whose raw and derived tables are written, and what was seen on the way."""

    stages: Stages
    raw: dict[str, Any]
    derived: dict[str, Any]

    def _one_row(self, schema: str, *values: Any) -> DataFrame:
        return self.stages.raw.sparkSession.createDataFrame([values], schema)

    def stage_counts(self) -> DataFrame:
        rows, clean, dedup = self.raw["rows"], self.raw["rows_clean"], self.derived["rows_dedup"]
        names = ["rows_raw", "rows_clean", "rows_dedup", "rows_valid", "removed_clean", "removed_duplicates"]
        return self._one_row(", ".join(f"{n} long" for n in names), rows, clean, dedup, self.derived["rows_valid"], rows - clean, clean - dedup)

    def _by_column(self) -> DataFrame:
        raw = self.stages.raw
        rows = [(c, raw.schema[c].dataType.simpleString(), self.raw[f"filled_{i}"], self.raw["rows"]) for i, c in enumerate(raw.columns)]
        return raw.sparkSession.createDataFrame(rows, "`column` string, type string, non_null long, rows long")

    def profile_schema(self) -> DataFrame:
        return self._by_column()

    def profile_nulls(self) -> DataFrame:
        nulls = self._by_column().select("column", (F.col("rows") - F.col("non_null")).alias("nulls"), "rows")
        return nulls.select("column", "nulls", rounded_percent("nulls", "rows").alias("pct"))

    def profile_invalid(self) -> DataFrame:
        names = ["negative_quantity", "non_positive_price"]
        return self._one_row(", ".join(f"{n} long" for n in names), *[self.raw[n] for n in names])

    def time_range(self) -> DataFrame:
        return self._one_row("first_time timestamp_ntz, last_time timestamp_ntz", self.raw["first_time"], self.raw["last_time"])

    def gross_revenue(self) -> DataFrame:
        return self._one_row("gross_revenue double", self.raw["gross_revenue"])

    def money_rejects(self) -> DataFrame:
        return self._one_row("sales long, rejected long, revenue double", *[self.derived[n] for n in ("sales", "rejected", "revenue")])

    def results(self) -> dict[str, DataFrame]:
        """Every observed result, under the name of the operator that computes it by a scan."""
        names = ["stage_counts", "profile_schema", "profile_nulls", "profile_invalid", "time_range", "gross_revenue", "money_rejects"]
        return {name: getattr(self, name)() for name in names}


def observe_stages(spark: SparkSession, raw: DataFrame) -> Observed:
    """Write raw and derived once, observed; raw is read once, in its own write."""
    raw, of_raw = _written(raw, spark, "raw", _raw_measures(raw))
    lazy = build_stages(raw)
    derived, of_derived = _written(lazy.derived, spark, "derived", _derived_measures())
    stages = Stages(raw=raw, clean=lazy.clean, dedup=lazy.dedup, derived=derived, valid=prepare.valid_rows(derived))
    return Observed(stages, of_raw, of_derived)
