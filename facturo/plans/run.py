"""Run the whole workload on an invoice-line CSV from the command line.

    python -m facturo.plans.run --input s3a://bucket/raw/lines.csv --output s3a://bucket/lake

The input defaults to the ``DATA_PATH`` environment variable. With
``--output`` the two text extracts are written to ``<output>/input``, the text
and order jobs read them from there, and every result is published under
``<output>/output/<name>`` (a directory of parts per result) when all are
complete; without it, the stage counts and every bounded result are printed
whole. Columns are bound by the names in the files' headers; lines that do not
fit are written as ``input_rejects``. The CSV is parsed once, and the raw and
derived stages are written under the shared checkpoint folder, where counts
and one-row profiles are observed on the way, unless ``--no-materialize`` is
given. Scratch tables are deleted at the end.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from facturo.operators import metrics, prepare, profile, segments, text
from facturo.plans.observed import observe_stages
from facturo.plans.workload import build_stages, twelve_queries
from facturo.session import build_session, scratch_scope, sizing_conf
from facturo.sources.bound import scan_csv_bound
from facturo.sources.files import write_pairs
from facturo.sources.zones import Zones, text_jobs_from_inputs, write_results, write_text_inputs

# Results that have one row per input line; they are written, never printed.
ROW_LEVEL = {"q01_clean", "q02_dedup", "q04_valid", "input_rejects"}


def all_results(stages) -> dict[str, DataFrame]:
    """The twelve queries plus the profile and the text/order jobs, all lazy."""
    raw = stages.raw
    lines = text.description_lines(raw)
    pairs = text.customer_quantity_pairs(raw)
    results = twelve_queries(stages)
    results.update(
        {
            "stage_counts": prepare.stage_counts(raw),
            "money_rejects": prepare.money_rejects(stages.derived),
            "customer_tiers": segments.customer_tiers(stages.valid),
            "combine_by_key": metrics.country_revenue_and_cancellations(stages.valid, stages.derived),
            "profile_schema": profile.profile_schema(raw),
            "profile_nulls": profile.profile_nulls(raw),
            "profile_duplicates": profile.profile_duplicates(raw),
            "duplicate_rows": profile.duplicate_rows(raw),
            "profile_cardinality": profile.profile_cardinality(raw),
            "profile_numeric": profile.profile_numeric_all(raw),
            "profile_text": profile.profile_text(raw),
            "profile_cancelled": profile.profile_cancelled(raw),
            "profile_invalid": profile.profile_invalid(raw),
            "time_range": profile.time_range(raw),
            "country_counts": profile.country_counts(raw),
            "monthly_line_counts": profile.monthly_line_counts(raw),
            "raw_top_products": profile.raw_top_products(raw),
            "raw_top_customers": profile.raw_top_customers(raw),
            "gross_revenue": profile.gross_revenue(raw),
            "mean_invoice_value": profile.mean_invoice_value(raw),
            "word_mean": text.word_mean(lines),
            "word_length_hist": text.word_length_hist(lines),
            "word_median": text.word_median(lines),
            "customer_quantity_sorted": text.customer_quantity_sorted(pairs),
        }
    )
    return results


def _input_bytes(spark: SparkSession, path: str) -> int:
    """Bytes under an input path of any file system, to size partitions; files are listed, not read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return listed.agg(F.sum("length")).first()[0] or 0


def main(argv: list[str] | None = None) -> dict[str, str]:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument(
        "--input", default=os.environ.get("DATA_PATH"), help="CSV file or directory (default: $DATA_PATH)"
    )
    parser.add_argument("--output", default=None, help="base folder of the raw/input/output zones")
    parser.add_argument("--no-materialize", action="store_true", help="keep every stage a lazy view")
    parser.add_argument("--master", default=None)
    args = parser.parse_args(argv)
    if not args.input:
        parser.error("--input or DATA_PATH is required")

    spark = build_session(master=args.master, app_name="facturo-run")
    for key, value in sizing_conf(_input_bytes(spark, args.input)).items():
        spark.conf.set(key, value)
    with scratch_scope(spark):
        return _run(spark, args.input, args.output, args.no_materialize)


def _run(spark: SparkSession, source: str, output: str | None, lazy: bool) -> dict[str, str]:
    scan = scan_csv_bound(spark, source)
    if lazy:
        results = all_results(build_stages(scan.rows))
    else:
        observed = observe_stages(spark, scan.rows)
        results = all_results(observed.stages) | observed.results()
        raw = observed.stages.raw
    results["input_rejects"] = scan.rejects

    if output:
        zones = Zones(output)
        write_text_inputs(scan.rows if lazy else raw, zones)
        results |= text_jobs_from_inputs(spark, zones)
        # the order job's result has one form, "id<TAB>qty" lines in order, and is sorted once
        ordered = results.pop("customer_quantity_sorted")
        paths = write_results(results, zones)
        paths["customer_quantity_sorted_txt"] = zones.output_path("customer_quantity_sorted_txt")
        write_pairs(ordered, paths["customer_quantity_sorted_txt"], sep="\t")
        return paths
    for name, df in results.items():
        if name in ROW_LEVEL or name == "customer_tiers" or name == "customer_quantity_sorted":
            continue
        print(f"== {name}")
        df = df.cache()  # bounded by months, countries or ten rows: printed whole
        df.show(max(1, df.count()), truncate=False)
        df.unpersist()
    return {}


if __name__ == "__main__":
    main()
