from __future__ import annotations

import datetime as dt

from conftest import line

from facturo.operators import profile, text


def test_profile_nulls_rounding(make_raw):
    rows = [line(cust=None)] + [line()] * 2  # 1 of 3 = 33.33 %
    got = {r["column"]: (r["nulls"], r["pct"]) for r in profile.profile_nulls(make_raw(rows)).collect()}
    assert got["Customer ID"] == (1, 33.33)
    assert got["Invoice"] == (0, 0.0)


def test_profile_nulls_half_up(make_raw):
    rows = [line(desc=None)] + [line()] * 7  # 12.5 % exactly
    got = {r["column"]: r["pct"] for r in profile.profile_nulls(make_raw(rows)).collect()}
    assert got["Description"] == 12.5


def test_duplicates_and_members(make_raw):
    rows = [line()] * 3 + [line(invoice="2")] * 2 + [line(invoice="3")]
    d = profile.profile_duplicates(make_raw(rows)).collect()[0]
    assert (d["duplicates"], d["rows_in_duplicate_groups"], d["duplicate_groups"]) == (3, 5, 2)
    members = profile.duplicate_rows(make_raw(rows), n=None).collect()
    assert [r["Invoice"] for r in members] == ["1", "1", "1", "2", "2"]
    first = profile.duplicate_rows(make_raw(rows), n=4).collect()
    assert [r["Invoice"] for r in first] == ["1", "1", "1", "2"]


def test_huge_copy_group_is_not_windowed(make_raw):
    rows = [line()] * 3000 + [line(invoice=str(i)) for i in range(2, 50)]
    df = make_raw(rows)
    top = profile.duplicate_rows(df, n=10)
    assert top.count() == 10
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_cardinality_skips_nulls(make_raw):
    rows = [line(cust=None), line(cust=1.0), line(cust=2.0, invoice="2"), line(country="Y")]
    got = {r["column"]: r["distinct"] for r in profile.profile_cardinality(make_raw(rows)).collect()}
    assert got == {"Country": 2, "Invoice": 2, "Customer ID": 2, "StockCode": 1}


def test_profile_text_top_tie_breaks_to_smallest(make_raw):
    rows = [line(country="B"), line(country="A"), line(country="C"), line(country="C", invoice="2")]
    rows += [line(country="A", invoice="3")]
    got = {r["column"]: r for r in profile.profile_text(make_raw(rows)).collect()}
    assert (got["Country"]["top"], got["Country"]["freq"], got["Country"]["unique"]) == ("A", 2, 3)


def test_profile_numeric_like_describe(make_raw):
    rows = [line(qty=q, invoice=str(i)) for i, q in enumerate([1, 2, 3, 4, 10])]
    got = {r["column"]: r for r in profile.profile_numeric(make_raw(rows)).collect()}
    q = got["Quantity"]
    assert (q["count"], q["mean"], q["min"], q["p25"], q["p50"], q["p75"], q["max"]) == (5, 4.0, 1.0, 2.0, 3.0, 4.0, 10.0)
    assert q["std"] == round(3.5355339059327378, 6)


def test_monthly_line_counts_fill_gaps(make_raw):
    rows = [
        line(date="2010-01-15 00:00:00"),
        line(date="2010-01-20 00:00:00"),
        line(date="2010-04-01 00:00:00"),
        line(date="garbage"),
    ]
    got = [(r["month_end"], r["lines"]) for r in profile.monthly_line_counts(make_raw(rows)).collect()]
    assert got == [
        (dt.date(2010, 1, 31), 2),
        (dt.date(2010, 2, 28), 0),
        (dt.date(2010, 3, 31), 0),
        (dt.date(2010, 4, 30), 1),
    ]


def test_raw_listings_and_revenue(make_raw):
    rows = [line(qty=5, price=2.0), line(qty=-2, price=2.0, invoice="C1"), line(desc=None, qty=50)]
    raw = make_raw(rows)
    assert profile.gross_revenue(raw).collect()[0][0] == 10.0 + 50.0
    top = profile.raw_top_products(raw).collect()
    assert [(r["Description"], r["Quantity"]) for r in top] == [("red plate", 3)]
    inv = profile.mean_invoice_value(raw).collect()[0][0]
    assert inv == ((10.0 + 50.0) + (-4.0)) / 2  # invoices "1" and "C1"
    bad = profile.profile_invalid(raw).collect()[0]
    assert (bad["negative_quantity"], bad["non_positive_price"]) == (1, 0)


def test_description_lines_strip_any_whitespace(make_raw):
    rows = [line(desc="  a  b\t"), line(desc="   "), line(desc=None), line(desc="\tx")]
    got = sorted(r["value"] for r in text.description_lines(make_raw(rows)).collect())
    assert got == ["a  b", "x"]


def test_word_stats(make_raw):
    rows = [line(desc="ab  abc"), line(desc=" a b c d "), line(desc="abcd")]
    lines = text.description_lines(make_raw(rows))
    m = text.word_mean(lines).collect()[0]
    assert (m["count"], m["length"]) == (7, 2 + 3 + 4 + 4)
    hist = [(r["length"], r["count"]) for r in text.word_length_hist(lines).collect()]
    assert hist == [(1, 4), (2, 1), (3, 1), (4, 1)]
    assert text.word_median(lines).collect()[0]["median_length"] == 1


def test_pairs_and_secondary_sort(make_raw):
    rows = [line(cust=5.0, qty=3), line(cust=5.0, qty=-1), line(cust=None, qty=9), line(cust=2.0, qty=7)]
    rows += [line(cust=9.0, qty=q % 4) for q in range(200)]  # one hot customer
    pairs = text.customer_quantity_pairs(make_raw(rows))
    out = [(r["customer_id"], r["quantity"]) for r in text.customer_quantity_sorted(pairs).collect()]
    assert out == sorted(out)
    assert out[:3] == [(2, 7), (5, -1), (5, 3)]
    assert len(out) == 203


def test_expand_counts_splits_hot_groups(spark):
    from facturo.operators.profile import expand_counts

    df = spark.createDataFrame([("a", 25), ("b", 1), ("c", 10)], "k string, n long")
    out = expand_counts(df, "n", chunk=4)
    got = {r["k"]: r["c"] for r in out.groupBy("k").agg({"*": "count"}).withColumnRenamed("count(1)", "c").collect()}
    assert got == {"a": 25, "b": 1, "c": 10}
    assert out.rdd.getNumPartitions() > 1


def test_cardinality_approx_switch(make_raw):
    rows = [line(invoice=str(i), cust=float(i % 50)) for i in range(500)]
    got = {r["column"]: r["distinct"] for r in profile.profile_cardinality(make_raw(rows), approx=True).collect()}
    assert abs(got["Invoice"] - 500) <= 15 and abs(got["Customer ID"] - 50) <= 2 and got["Country"] == 1


def test_secondary_sort_splits_a_hot_pair(spark):
    from facturo.operators.ordering import secondary_sort

    rows = [(1, 5)] * 2500 + [(1, 3)] * 7 + [(0, 9)] * 2 + [(2, -1)]
    df = spark.createDataFrame(rows, "customer_id long, quantity int")
    out = secondary_sort(df, "customer_id", "quantity", chunk=100)
    got = [(r[0], r[1]) for r in out.collect()]
    assert got == sorted(rows)
    # Without AQE folding tiny partitions together, the hot pair's 25 chunks
    # land in several range partitions.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        from pyspark.sql import functions as F

        hot = out.withColumn("pid", F.spark_partition_id()).filter("customer_id = 1 AND quantity = 5")
        assert hot.select("pid").distinct().count() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_rounded_percent_is_exact_half_up(spark):
    import random
    from decimal import ROUND_HALF_UP, Decimal

    from facturo.functions import rounded_percent

    rnd = random.Random(5)
    pairs = [(p, w) for w in [rnd.randint(1, 10**7) for _ in range(3000)] for p in [rnd.randint(0, w)]]
    pairs += [(1, 8), (1, 3), (2, 3), (1, 200000), (0, 1), (5, 5)]
    df = spark.createDataFrame(pairs, "part long, whole long")
    got = [r[0] for r in df.select(rounded_percent("part", "whole")).collect()]
    want = [float((Decimal(p) * 100 / Decimal(w)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)) for p, w in pairs]
    assert got == want
