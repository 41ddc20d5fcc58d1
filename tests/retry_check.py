"""Run key queries with injected first-attempt task failures; print JSON results.

Executed in its own process by test_retries.py (a Spark master with task
retries, ``local[4,3]``, needs its own JVM). The failure injection is a
test-only Python step that raises in the first attempt of every second scan
task; Spark retries those tasks and the results must not change.
"""

from __future__ import annotations

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark import TaskContext  # noqa: E402

from facturo.operators import metrics, prepare, segments, text  # noqa: E402
from facturo.plans.workload import build_stages  # noqa: E402
from facturo.session import build_session  # noqa: E402
from facturo.sources.fixture import invoice_lines  # noqa: E402


def flaky(batches):
    ctx = TaskContext.get()
    if ctx.attemptNumber() == 0 and ctx.partitionId() % 2 == 0:
        raise RuntimeError("injected failure")
    yield from batches


def results(raw):
    s = build_stages(raw)
    pairs = text.customer_quantity_sorted(text.customer_quantity_pairs(raw))
    return {
        "stage_counts": [r.asDict() for r in prepare.stage_counts(raw).collect()],
        "tier_counts": [r.asDict() for r in segments.tier_counts(s.valid).collect()],
        "country_revenue": [r.asDict() for r in metrics.country_revenue(s.valid).collect()],
        "sorted_pairs": [tuple(r) for r in pairs.collect()],
    }


def main() -> None:
    sf_dir = sys.argv[1]
    spark = build_session(master="local[4,3]", shuffle_partitions=4)
    spark.sparkContext.setLogLevel("WARN")  # lost-task warnings show the injected failures
    raw = invoice_lines(spark, sf_dir).repartition(4)
    clean_run = results(raw)
    failing = raw.mapInPandas(flaky, raw.schema)
    retried_run = results(failing)
    print(json.dumps({"equal": clean_run == retried_run, "pairs": len(clean_run["sorted_pairs"])}))
    spark.stop()


if __name__ == "__main__":
    main()
