from __future__ import annotations

import contextlib
import glob
import io
import os
import re

from conftest import SF_SMALL, line

from facturo.operators import metrics, prepare, segments
from facturo.plans.workload import build_stages, materialize_stages, stages_from_tables, twelve_queries
from facturo.schema import PAIRS_SCHEMA
from facturo.session import scratch_path
from facturo.sources import files
from facturo.sources.fixture import invoice_lines


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_csv_roundtrip_keeps_quotes_commas_and_blanks(spark, make_raw):
    rows = [
        line(desc='BOX, "LARGE" ""RED""'),
        line(desc="   "),
        line(desc="NA"),
        line(desc=None, cust=None, price=None),
    ]
    raw = make_raw(rows)
    path = scratch_path(spark, "csv-test")
    files.write_csv(raw, path)
    back = files.scan_csv_typed(spark, path)
    assert back.exceptAll(raw).count() == 0 and raw.exceptAll(back).count() == 0


def test_csv_bad_numbers_become_null(spark):
    path = scratch_path(spark, "csv-bad")
    os.makedirs(path)
    with open(os.path.join(path, "part.csv"), "w") as f:
        f.write("Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country\n")
        f.write('1,P1,"a, b",2.0,2010-01-01 00:00:00,bad,13085.0,UK\n')
    row = files.scan_csv_typed(spark, path).collect()[0]
    assert row["Description"] == "a, b" and row["Quantity"] is None and row["Price"] is None
    assert row["Customer ID"] == 13085.0


def test_pairs_and_text_roundtrip(spark):
    pairs = spark.createDataFrame([(13085, -3), (12, 7)], PAIRS_SCHEMA)
    path = scratch_path(spark, "pairs-test")
    files.write_pairs(pairs, path)
    with open(next(os.path.join(path, f) for f in sorted(os.listdir(path)) if f.startswith("part-") and os.path.getsize(os.path.join(path, f)))) as f:
        assert f.readline().strip() in {"13085 -3", "12 7"}
    assert sorted(tuple(r) for r in files.scan_pairs(spark, path).collect()) == [(12, 7), (13085, -3)]
    lines = spark.createDataFrame([("a b",), ("c",)], "value string")
    tpath = scratch_path(spark, "text-test")
    files.write_text_lines(lines, tpath)
    assert sorted(r["value"] for r in files.scan_text_lines(spark, tpath).collect()) == ["a b", "c"]


def test_fixture_counts_at_smallest_scale(spark):
    raw = invoice_lines(spark, SF_SMALL)
    counts = prepare.stage_counts(raw).collect()[0].asDict()
    assert counts == {"rows_raw": 6029, "rows_clean": 5956, "rows_dedup": 5925, "rows_valid": 5792, "removed_clean": 73, "removed_duplicates": 31}


def test_valid_filter_reaches_parquet_scan(spark):
    stages = materialize_stages(spark, stages_from_tables(spark, SF_SMALL))
    plan = _formatted(stages.valid)
    assert "GreaterThan(Quantity,0)" in plan and "GreaterThan(Price,0.0)" in plan
    top = metrics.top_products_revenue(stages.valid)
    plan = _formatted(top)
    assert "TakeOrderedAndProject" in plan
    # Only the columns the query and its filter need are read from the file.
    schema = next(x for x in plan.splitlines() if x.startswith("ReadSchema:"))
    fields = set(re.findall(r"[<,]([A-Za-z ]+):", schema))
    assert fields == {"Description", "TotalPrice", "Quantity", "Price", "IsCancelled"}
    assert "Not(EqualTo(IsCancelled,true))" in plan


def test_no_python_in_plans(spark):
    stages = stages_from_tables(spark, SF_SMALL)
    for name, df in twelve_queries(stages).items():
        plan = df._jdf.queryExecution().sparkPlan().toString()
        for marker in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
            assert marker not in plan, (name, marker)


def test_tiers_use_one_cut_subquery(spark, make_raw):
    rows = [line(invoice=str(i), cust=float(i % 17), price=float(i)) for i in range(200)]
    valid = build_stages(make_raw(rows)).valid
    plan = _formatted(segments.customer_tiers(valid))
    assert len(re.findall(r"^Subquery:\d+ Hosting", plan, flags=re.M)) == 1


def test_zones_and_text_extracts(spark):
    from facturo.operators import text
    from facturo.sources.zones import Zones, text_jobs_from_inputs, write_results, write_text_inputs

    raw = invoice_lines(spark, SF_SMALL)
    zones = Zones(scratch_path(spark, "zones"))
    write_text_inputs(raw, zones)
    jobs = text_jobs_from_inputs(spark, zones)
    direct = text.word_mean(text.description_lines(raw)).collect()
    assert jobs["word_mean"].collect() == direct
    paths = write_results({"word_length_hist": jobs["word_length_hist"]}, zones)
    back = sorted(tuple(r) for r in spark.read.parquet(paths["word_length_hist"]).collect())
    assert back == sorted(tuple(r) for r in text.word_length_hist(text.description_lines(raw)).collect())
    pairs = sorted(tuple(r) for r in jobs["customer_quantity_sorted"].collect())
    assert pairs == sorted(tuple(r) for r in text.customer_quantity_pairs(raw).collect())


def test_sizing_conf():
    from facturo.session import sizing_conf

    conf = sizing_conf(100 * (1 << 40))
    assert conf["spark.sql.shuffle.partitions"] == str(100 * (1 << 40) // (256 << 20))
    assert sizing_conf(1)["spark.sql.shuffle.partitions"] == "8"


def test_command_line_run_writes_every_result(spark):
    from facturo.plans import run

    raw = invoice_lines(spark, SF_SMALL)
    csv_path = scratch_path(spark, "run-input")
    files.write_csv(raw, csv_path)
    out = scratch_path(spark, "run-output")
    paths = run.main(["--input", csv_path, "--output", out])
    assert len(paths) >= 30
    counts = spark.read.parquet(paths["stage_counts"]).collect()[0].asDict()
    assert counts == {"rows_raw": 6029, "rows_clean": 5956, "rows_dedup": 5925, "rows_valid": 5792, "removed_clean": 73, "removed_duplicates": 31}
    top = spark.read.parquet(paths["q05_top_products_revenue"]).count()
    assert top == 10
    lines = []
    for part in sorted(glob.glob(os.path.join(paths["customer_quantity_sorted_txt"], "part-*"))):
        with open(part) as f:
            lines += [tuple(int(x) for x in ln.rstrip("\n").split("\t")) for ln in f if ln.strip()]
    assert lines == sorted(lines) and len(lines) == raw.filter("`Customer ID` IS NOT NULL AND Quantity IS NOT NULL").count()


_PASS_THROUGH = {"Project", "Filter", "Sort", "WholeStageCodegen", "InputAdapter", "ColumnarToRow"}
_BOUNDED = {"HashAggregate", "ObjectHashAggregate", "SortAggregate", "TakeOrderedAndProject", "GlobalLimit", "LocalLimit"}


def _single_partition_inputs(node, found):
    if node.nodeName() == "Exchange" and node.outputPartitioning().toString() == "SinglePartition":
        child = node.children().apply(0)
        while child.nodeName() in _PASS_THROUGH or child.nodeName().startswith("WholeStageCodegen"):
            child = child.children().apply(0)
        found.append(child.nodeName())
    children = node.children()
    for i in range(children.size()):
        _single_partition_inputs(children.apply(i), found)
    return found


def test_single_partition_exchanges_only_over_aggregates(spark):
    from facturo.plans import catalog

    raw = invoice_lines(spark, SF_SMALL)
    skip = {"scan_csv_typed", "scan_pairs", "result_roundtrip"}  # these write files when called
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for name, fn in catalog.raw_queries().items():
            if name in skip:
                continue
            plan = fn(spark, raw)._jdf.queryExecution().executedPlan()
            inputs = _single_partition_inputs(plan, [])
            assert set(inputs) <= _BOUNDED, (name, inputs)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_checkpoint_dir_required_on_a_cluster():
    import pytest as _pytest

    from facturo.session import ensure_checkpoint_dir

    class _Conf:
        def __init__(self, values):
            self.values = values

        def get(self, key, default=None):
            return self.values.get(key, default)

        def set(self, key, value):
            self.values[key] = value

    class _Session:
        def __init__(self, values):
            self.conf = _Conf(values)

    with _pytest.raises(RuntimeError):
        ensure_checkpoint_dir(_Session({"spark.master": "yarn"}))
    assert ensure_checkpoint_dir(_Session({"spark.master": "yarn", "spark.checkpoint.dir": "hdfs:///ckpt"})) == "hdfs:///ckpt"


def test_invoice_lines_built_once_per_session(spark):
    from facturo.plans.catalog import invoice_lines_table

    first = invoice_lines_table(spark, SF_SMALL)
    second = invoice_lines_table(spark, SF_SMALL)
    assert first.inputFiles() == second.inputFiles()
    assert first.count() == 6029
    assert first.exceptAll(invoice_lines(spark, SF_SMALL)).count() == 0


def test_csv_multiline_descriptions(spark, make_raw):
    raw = make_raw([line(desc="two\nlines, quoted"), line(desc="plain")])
    path = scratch_path(spark, "csv-multiline")
    files.write_csv(raw, path)
    back = files.scan_csv_typed(spark, path, multiline=True)
    assert sorted(r["Description"] for r in back.collect()) == ["plain", "two\nlines, quoted"]


def test_command_line_run_prints_bounded_results(spark, capsys):
    from facturo.plans import run

    csv_path = scratch_path(spark, "run-print-input")
    files.write_csv(invoice_lines(spark, SF_SMALL), csv_path)
    assert run.main(["--input", csv_path, "--no-materialize"]) == {}
    out = capsys.readouterr().out
    for name in ("q05_top_products_revenue", "q11_tier_counts", "profile_nulls", "word_median"):
        assert f"== {name}" in out
    assert "== q01_clean" not in out  # row-level stages are never printed


def test_empty_partitioned_roundtrip_keeps_schema(spark, make_raw):
    derived = build_stages(make_raw([line(price=0.0)])).derived  # everything cleaned away
    back = files.result_roundtrip(spark, derived, scratch_path(spark, "empty-rt"), partition_by=["Year", "Month"])
    assert back.count() == 0
    assert sorted(back.columns) == sorted(derived.columns)
