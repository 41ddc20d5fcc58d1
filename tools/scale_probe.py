"""Time the heavier operators on the invoice lines and on a k-times expansion.

Usage: python tools/scale_probe.py [sf_dir] [k]

The expansion repeats every line k times with the invoice and customer made
distinct per copy, so groups grow by k while the value domains stay the same.
Prints one line per size with seconds per step (see PLANS.md).
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from facturo.operators import metrics, prepare, profile, segments, text  # noqa: E402
from facturo.plans.workload import build_stages  # noqa: E402
from facturo.schema import CUSTOMER_ID, INVOICE, RAW_COLUMNS  # noqa: E402
from facturo.session import build_session, materialize  # noqa: E402
from facturo.sources.fixture import invoice_lines  # noqa: E402


def expand(raw, k: int):
    copy = F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
    return (
        raw.withColumn("_k", copy)
        .withColumn(INVOICE, F.concat(F.col(INVOICE), F.lit("-"), F.col("_k").cast("string")))
        .withColumn(CUSTOMER_ID, F.col(CUSTOMER_ID) + F.col("_k") * F.lit(1e6))
        .select(*RAW_COLUMNS)
    )


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    k_max = int(sys.argv[2]) if len(sys.argv) > 2 else 10
    spark = build_session(master="local[8]", app_name="facturo-scale-probe", shuffle_partitions=32)
    spark.sparkContext.setLogLevel("ERROR")
    base = materialize(invoice_lines(spark, sf_dir), spark, "probe-base")
    for k in (1, k_max):
        raw = materialize(expand(base, k), spark, f"probe-raw-{k}")
        times: dict[str, float] = {}

        def timed(name, fn):
            t0 = time.perf_counter()
            fn()
            times[name] = round(time.perf_counter() - t0, 2)

        holder = {}
        timed("dedup_derive_write", lambda: holder.update(d=materialize(build_stages(raw).derived, spark, "probe-d")))
        valid = prepare.valid_rows(holder["d"])
        timed("tier_counts", lambda: segments.tier_counts(valid).collect())
        timed("country_revenue", lambda: metrics.country_revenue(valid).collect())
        timed("profile_numeric_all", lambda: profile.profile_numeric_all(raw).collect())
        pairs = text.customer_quantity_pairs(raw)
        timed(
            "customer_quantity_sorted",
            lambda: text.customer_quantity_sorted(pairs).write.format("noop").mode("overwrite").save(),
        )
        timed("word_median", lambda: text.word_median(text.description_lines(raw)).collect())
        print(k, raw.count(), times, flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
