"""Published values of the fixture mapping at sf0.01 (FIXTURES.md) and identities."""

from __future__ import annotations

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def run(spark):
    q = E.queries()

    def one(name):
        return [r.asDict() for r in q[name](spark, SF).collect()]

    return one


def test_funnel(run):
    assert run("stage_counts") == [{"rows_raw": 60282, "rows_clean": 59723, "rows_dedup": 59440, "rows_valid": 58098, "removed_clean": 559, "removed_duplicates": 283}]


def test_profile_values(run):
    numeric = {r["column"]: r for r in run("profile_numeric")}
    q = numeric["Quantity"]
    assert (q["mean"], q["std"], q["p25"], q["p50"], q["p75"]) == (24.229455, 16.313463, 12.0, 25.0, 38.0)
    desc = next(r for r in run("profile_text") if r["column"] == "Description")
    assert (desc["top"], desc["freq"]) == ("red plate", 1385)
    nulls = {r["column"]: r["nulls"] for r in run("profile_nulls")}
    assert (nulls["Customer ID"], nulls["Description"]) == (13686, 252)
    assert run("profile_invalid") == [{"negative_quantity": 1356, "non_positive_price": 307}]
    assert run("profile_cancelled")[0]["count"] == 1183
    d = run("profile_duplicates")[0]
    assert (d["duplicates"], d["rows_in_duplicate_groups"]) == (284, 568)
    card = {r["column"]: r["distinct"] for r in run("profile_cardinality")}
    assert card == {"Customer ID": 1166, "Invoice": 14743, "StockCode": 2000, "Country": 25}


def test_money_values(run):
    assert run("gross_revenue") == [{"gross_revenue": 1413829821.3}]
    assert run("mean_invoice_value") == [{"mean_invoice_value": 93648.71573628162}]
    assert run("aov_global")[0]["AOV"] == 97386.4602196122
    assert len(run("monthly_revenue")) == 80


def test_word_identities(run):
    mean = run("word_mean")[0]
    hist = run("word_length_hist")
    assert (mean["count"], mean["length"]) == (120060, 496096)
    assert sum(r["count"] for r in hist) == mean["count"]
    assert sum(r["count"] * r["length"] for r in hist) == mean["length"]
    assert run("word_median") == [{"median_length": 4}]
    assert len(run("customer_quantity_pairs")) == 46596


def test_tiers_partition_customers(run):
    counts = {r["Tier"]: r["count"] for r in run("tier_counts")}
    assert sum(counts.values()) == len(run("customer_tiers"))
