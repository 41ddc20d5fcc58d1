"""CSV files bound by their headers, rejected lines, and money at the ends of its range."""

from __future__ import annotations

import pytest
from conftest import line

from facturo.operators import metrics, prepare
from facturo.plans.workload import build_stages
from facturo.schema import RAW_COLUMNS
from facturo.sources import csv_headers, scan_csv_bound

USUAL = ",".join(RAW_COLUMNS)


def _file(folder, name, *lines):
    (folder / name).write_text("\n".join(lines) + "\n", encoding="utf-8")


def _rows(df):
    return sorted(map(tuple, df.select(*RAW_COLUMNS).collect()))


def test_columns_in_any_order_give_the_same_rows(spark, tmp_path):
    values = {"Invoice": "1", "StockCode": "A", "Description": '"a, ""b"""', "Quantity": "2", "InvoiceDate": "2010-01-05", "Price": "1.5", "Customer ID": "7.0", "Country": "UK"}
    order = list(reversed(RAW_COLUMNS))
    _file(tmp_path, "a.csv", USUAL, ",".join(values[c] for c in RAW_COLUMNS))
    _file(tmp_path, "b.csv", "\ufeff" + ",".join([*order, "Note"]), *[",".join([*[values[c] for c in order], "n"])] * 2)
    _file(tmp_path, "c.csv", "", USUAL)
    scan = scan_csv_bound(spark, str(tmp_path))
    assert _rows(scan.rows) == [("1", "A", 'a, "b"', 2, "2010-01-05", 1.5, 7.0, "UK")] * 3
    assert scan.rejects.count() == 0 and scan.rows.columns == RAW_COLUMNS
    assert {k[0] for k in csv_headers(spark, [str(tmp_path)])} == {"Invoice", "Country"}


def test_lines_that_do_not_fit_are_set_aside_whole(spark, tmp_path):
    good = "1,A,x,2,2010-01-05,1.5,7.0,UK"
    bad = ["2,A,x,two,2010-01-05,1.5,7.0,UK", "3,A,x,2,2010-01-05,1.5,7.0", "4,A,x,2,2010-01-05,1.5,7.0,UK,more", "5,A,x,99999999999,2010-01-05,1.5,,UK"]
    _file(tmp_path, "a.csv", USUAL, good, *bad, "6,,,,,,,")
    scan = scan_csv_bound(spark, str(tmp_path / "a.csv"))
    assert sorted(r["line"] for r in scan.rejects.collect()) == sorted(bad)
    assert scan.rejects.count() == 4 and scan.rows.count() == 2
    # whichever columns a query reads, the same lines are rejected
    assert sorted(r["Invoice"] for r in scan.rows.select("Invoice").collect()) == ["1", "6"]
    assert scan.rejects.first()["file"].endswith("a.csv")


def test_missing_and_repeated_columns(spark, tmp_path):
    _file(tmp_path, "a.csv", "Invoice,Price", "1,2.5")
    with pytest.raises(ValueError, match="missing from the header"):
        scan_csv_bound(spark, str(tmp_path))
    row = scan_csv_bound(spark, str(tmp_path), missing="null").rows.first()
    assert row["Invoice"] == "1" and row["Price"] == 2.5 and row["Country"] is None
    _file(tmp_path, "a.csv", USUAL + ",Price", "x")
    with pytest.raises(ValueError, match="more than once"):
        scan_csv_bound(spark, str(tmp_path))


def test_no_files_with_a_header(spark, tmp_path):
    _file(tmp_path, "a.csv", "", "")
    scan = scan_csv_bound(spark, str(tmp_path))
    assert scan.rows.count() == 0 and scan.rejects.count() == 0


def test_extreme_prices_are_summed_or_reported(make_raw):
    raw = make_raw([line(invoice="1", price=1e11, qty=1, country="X"), line(invoice="2", price=0.00004, qty=100000, country="X")])
    stages = build_stages(raw)
    report = prepare.money_rejects(stages.derived).first()
    assert (report["sales"], report["rejected"], report["revenue"]) == (2, 0, 1e11 + 4.0)
    country = metrics.country_revenue(stages.valid).first()
    assert (country["Revenue"], country["Facturas"]) == (1e11 + 4.0, 2)


def test_totals_that_cannot_be_held_are_no_silent_nulls(make_raw):
    prices = [1e13, 1e300, 1e-12, 5e-324, float("inf"), float("nan")]
    raw = make_raw([line(invoice=str(i), price=p) for i, p in enumerate(prices)] + [line(invoice="ok", price=9.99e12, qty=2**31 - 1)])
    stages = build_stages(raw)
    report = prepare.money_rejects(stages.derived).first()
    assert (report["sales"], report["rejected"]) == (7, 6)
    assert [r["Invoice"] for r in stages.valid.collect()] == ["ok"]
    counts = prepare.stage_counts(raw).first()
    assert (counts["rows_dedup"], counts["rows_valid"]) == (7, 1)
    assert metrics.aov_global(stages.valid).first()["AOV"] == pytest.approx(9.99e12 * (2**31 - 1))
