"""Results published in one step, scratch tables that go, and profiles observed while stages are written."""

from __future__ import annotations

import os

import pytest
from conftest import SF_SMALL, line
from pyspark.sql import functions as F

from facturo.operators import prepare, profile
from facturo.plans import run
from facturo.plans.observed import observe_stages
from facturo.session import discard, materialize, scratch_path, scratch_scope
from facturo.sources import files, invoice_lines
from facturo.sources.zones import Zones, write_results


def _failing(spark):
    return spark.range(100, numPartitions=4).withColumn("x", F.when(F.col("id") == 99, F.raise_error(F.lit("lost"))).otherwise("a"))


@pytest.mark.parametrize("write", [files.write_parquet, files.write_csv, lambda df, path: files.write_text_lines(df.select("x"), path), lambda df, path: files.write_pairs(df, path)])
def test_a_failed_write_keeps_the_old_result(spark, tmp_path, write):
    path = str(tmp_path / "zone" / "result")
    write(spark.range(7).withColumn("x", F.lit("old")), path)
    before = sorted(os.listdir(path))
    with pytest.raises(Exception, match="lost"):
        write(_failing(spark), path)
    assert sorted(os.listdir(path)) == before and os.listdir(tmp_path / "zone") == ["result"]
    write(spark.range(3).withColumn("x", F.lit("new")), path)
    back = spark.read.parquet(path).select(F.col("x").alias("value")) if write is files.write_parquet else spark.read.text(path)
    assert back.where("value like '%new%'").count() == 3 and back.where("value like '%old%'").count() == 0
    assert os.listdir(tmp_path / "zone") == ["result"]


def test_a_set_of_results_is_published_together(spark, tmp_path):
    zones = Zones(str(tmp_path))
    paths = write_results({"a": spark.range(3), "b": spark.range(4)}, zones)
    with pytest.raises(Exception, match="lost"):
        write_results({"a": spark.range(30), "b": _failing(spark)}, zones)
    assert spark.read.parquet(paths["a"]).count() == 3 and spark.read.parquet(paths["b"]).count() == 4
    assert sorted(os.listdir(zones.output)) == ["a", "b"]


def test_partitioned_files_do_not_grow_with_tasks(spark, tmp_path):
    df = spark.range(40_000, numPartitions=32).selectExpr("id", "id % 3 as m")
    files.write_parquet(df, str(tmp_path / "p"), partition_by=["m"])
    parts = [f for d, _, names in os.walk(tmp_path / "p") for f in names if f.startswith("part-")]
    assert len(parts) <= 12 and spark.read.parquet(str(tmp_path / "p")).count() == 40_000


def test_scratch_tables_go_with_their_scope(spark):
    with scratch_scope(spark) as outer:
        with scratch_scope(spark) as scope:
            a = materialize(spark.range(5), spark, "a")
            b = scope.keep(materialize(a, spark, "b"))
            gone, kept = a.inputFiles()[0], b.inputFiles()[0]
        assert not os.path.exists(gone.removeprefix("file://")) and b.count() == 5
        c = materialize(spark.range(2), spark, "c")
        outer.clear(unless_read_by=b)
        assert b.count() == 5 and len(outer.paths) == 1
    assert not os.path.exists(kept.removeprefix("file://"))
    path = scratch_path(spark, "free")
    assert "free" in path
    d = materialize(spark.range(2), spark, "d")
    at = d.inputFiles()[0].removeprefix("file://")
    discard(c, d)
    assert not os.path.exists(at)


def test_observed_values_are_those_of_the_scans(spark):
    raw = invoice_lines(spark, SF_SMALL)
    seen = observe_stages(spark, raw)
    by_scan = {
        "stage_counts": prepare.stage_counts(raw),
        "money_rejects": prepare.money_rejects(seen.stages.derived),
        **{name: getattr(profile, name)(raw) for name in ("profile_schema", "profile_nulls", "profile_invalid", "time_range", "gross_revenue")},
    }
    observed = seen.results()
    assert set(observed) == set(by_scan)
    for name, df in by_scan.items():
        assert sorted(map(tuple, observed[name].select(df.columns).collect())) == sorted(map(tuple, df.collect())), name
        assert observed[name].schema.simpleString() == df.select(observed[name].columns).schema.simpleString(), name


def test_observed_empty_and_all_cleaned_away(spark, make_raw):
    for rows in ([], [line(price=0.0)], [line(desc=None)] * 3):
        seen = observe_stages(spark, make_raw(rows))
        assert seen.stage_counts().first()["rows_raw"] == len(rows) and seen.stage_counts().first()["rows_dedup"] == 0
        assert seen.gross_revenue().first()["gross_revenue"] == profile.gross_revenue(make_raw(rows)).first()["gross_revenue"]


def test_the_runner_reads_the_extracts_and_leaves_no_scratch(spark, tmp_path):
    source = str(tmp_path / "in")
    files.write_csv(invoice_lines(spark, SF_SMALL), source)
    with open(os.path.join(source, "more.csv"), "w") as out:
        out.write("Country,Price,Invoice,StockCode,Description,Quantity,InvoiceDate,Customer ID\nX,two,1,A,b,1,2010-01-01,3\n")
    folder = os.path.dirname(scratch_path(spark, "x"))
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    paths = run.main(["--input", source, "--output", str(tmp_path / "lake")])
    assert set(os.listdir(folder)) <= before
    assert sorted(os.listdir(tmp_path / "lake")) == ["input", "output"]
    assert sorted(os.listdir(tmp_path / "lake" / "input")) == ["customer_quantity", "descriptions"]
    assert "customer_quantity_sorted" not in paths
    rejects = spark.read.parquet(paths["input_rejects"]).collect()
    assert [r["line"] for r in rejects] == ["X,two,1,A,b,1,2010-01-01,3"]
    assert spark.read.parquet(paths["stage_counts"]).first()["rows_raw"] == 6029
