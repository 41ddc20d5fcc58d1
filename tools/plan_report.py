"""Static plan summary of every registered query (AQE off, so every exchange shows).

Usage: python tools/plan_report.py [sf_dir] [--materialized]

For each query: hash/range shuffles, broadcasts, single-partition exchanges
(and what they sit on), scans, and whether any Python evaluation appears.
With ``--materialized`` the queries run over a written invoice-line table
(as in bench.py) instead of the driver-table joins.
"""

from __future__ import annotations

import os
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from facturo.plans import catalog  # noqa: E402
from facturo.session import build_session, materialize  # noqa: E402
from facturo.sources.fixture import invoice_lines  # noqa: E402

PASS_THROUGH = {"Project", "Filter", "Sort", "InputAdapter", "ColumnarToRow"}
FILE_WRITERS = {"scan_csv_typed", "scan_pairs", "result_roundtrip"}


def _walk(node, stats: Counter, single: list) -> None:
    name = node.nodeName()
    if name == "Exchange":
        part = node.outputPartitioning().toString()
        if part == "SinglePartition":
            child = node.children().apply(0)
            while child.nodeName() in PASS_THROUGH or child.nodeName().startswith("WholeStageCodegen"):
                child = child.children().apply(0)
            single.append(child.nodeName())
        else:
            stats["range" if part.startswith("rangepartitioning") else "hash"] += 1
    elif name == "BroadcastExchange":
        stats["broadcast"] += 1
    elif name.startswith("Scan ") or name.startswith("FileScan"):
        stats["scans"] += 1
    elif "Python" in name or "Pandas" in name:
        stats["python"] += 1
    children = node.children()
    for i in range(children.size()):
        _walk(children.apply(i), stats, single)


def main() -> None:
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    spark = build_session(master="local[4]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    raw = invoice_lines(spark, sf_dir)
    if "--materialized" in sys.argv:
        raw = materialize(raw, spark, "plan-report-raw")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    print("| query | hash shuffles | range shuffles | broadcasts | single-partition over | scans | python |")
    print("| --- | --- | --- | --- | --- | --- | --- |")
    for name, fn in catalog.raw_queries().items():
        if name in FILE_WRITERS:
            continue
        plan = fn(spark, raw)._jdf.queryExecution().executedPlan()
        stats, single = Counter(), []
        _walk(plan, stats, single)
        over = ", ".join(f"{k} x{v}" for k, v in Counter(single).items()) or "-"
        print(
            f"| {name} | {stats['hash']} | {stats['range']} | {stats['broadcast']} | {over} | "
            f"{stats['scans']} | {stats['python']} |"
        )


if __name__ == "__main__":
    main()
