from __future__ import annotations

from conftest import line

from facturo.operators import metrics, prepare, segments


def _valid(raw):
    return prepare.prepared_stages(raw)["valid"]


def test_top_k_ties_go_to_smallest_key(make_raw):
    rows = [line(invoice=str(i), desc=f"item{i:02d}", price=10.0) for i in range(12)]
    top = metrics.top_products_revenue(_valid(make_raw(rows)), n=10).collect()
    assert [r["Description"] for r in top] == [f"item{i:02d}" for i in range(10)]
    assert all(r["TotalPrice"] == 10.0 for r in top)


def test_money_is_exact(make_raw):
    rows = [line(invoice=str(i), price=0.1) for i in range(10)] + [line(invoice="x", price=0.2)]
    top = metrics.top_products_revenue(_valid(make_raw(rows))).collect()
    assert top[0]["TotalPrice"] == 1.2  # 0.1 * 10 + 0.2 exactly, no float drift


def test_top_customers_skips_unknown(make_raw):
    rows = [line(invoice="1", cust=None, price=100.0), line(invoice="2", cust=7.0, price=1.0)]
    top = metrics.top_customers(_valid(make_raw(rows))).collect()
    assert [(r["Customer ID"], r["TotalPrice"]) for r in top] == [(7.0, 1.0)]


def test_top_customers_all_null(make_raw):
    rows = [line(invoice=str(i), cust=None) for i in range(5)]
    assert metrics.top_customers(_valid(make_raw(rows))).count() == 0


def test_country_revenue_counts_distinct_invoices(make_raw):
    rows = [
        line(invoice="1", country="A", price=2.0),
        line(invoice="1", stock="P2", country="A", price=3.0),
        line(invoice="2", country="A", price=5.0),
        line(invoice="3", country="B", price=1.0),
    ]
    got = {r["Country"]: r.asDict() for r in metrics.country_revenue(_valid(make_raw(rows))).collect()}
    assert got["A"]["Revenue"] == 10.0 and got["A"]["Facturas"] == 2 and got["A"]["TicketPromedio"] == 5.0
    assert list(got) == ["A", "B"]


def test_monthly_revenue_change_with_zero_and_gap(make_raw):
    rows = [
        line(invoice="1", date="2010-01-02 00:00:00", price=1.0, qty=1),
        line(invoice="2", date="2010-01-03 00:00:00", price=1.0, qty=-1),  # not valid
        line(invoice="3", date="2010-03-02 00:00:00", price=2.0),
        line(invoice="4", date="2010-04-02 00:00:00", price=3.0),
    ]
    got = [r.asDict() for r in metrics.monthly_revenue(_valid(make_raw(rows))).collect()]
    assert [(r["Year"], r["Month"]) for r in got] == [(2010, 1), (2010, 3), (2010, 4)]
    assert got[0]["VariacionPct"] is None
    assert got[1]["VariacionPct"] == 100.0  # against the previous month present
    assert got[2]["VariacionPct"] == 50.0


def test_monthly_revenue_previous_zero_is_null(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(
        [(2010, 1, "0.0000"), (2010, 2, "5.0000")], "Year int, Month int, TotalPrice string"
    ).withColumn("TotalPrice", F.col("TotalPrice").cast("decimal(32,8)"))
    got = metrics.monthly_revenue(df).collect()
    assert got[1]["VariacionPct"] is None


def test_country_cancellation_threshold_is_inclusive(make_raw):
    rows = [line(invoice=f"C{i}" if i < 3 else str(i), stock=f"S{i}", country="A") for i in range(29)]
    rows += [line(invoice=f"C{i}" if i < 6 else str(i), stock=f"S{i}", country="B") for i in range(30)]
    derived = prepare.prepared_stages(make_raw(rows))["derived"]
    got = metrics.country_cancellation(derived).collect()
    assert [(r["Country"], r["Total"], r["Canceladas"], r["TasaCancelacion"]) for r in got] == [("B", 30, 6, 20.0)]


def test_skewed_country_is_aggregated(make_raw):
    rows = [line(invoice=str(i), stock=f"S{i}", country="UK") for i in range(900)]
    rows += [line(invoice=f"x{i}", stock=f"S{i}", country=f"C{i % 5}") for i in range(100)]
    got = {r["Country"]: r["Facturas"] for r in metrics.country_revenue(_valid(make_raw(rows))).collect()}
    assert got["UK"] == 900 and sum(got.values()) == 1000


def test_aov_global_and_monthly(make_raw):
    rows = [
        line(invoice="1", price=2.0, date="2010-01-01 00:00:00"),
        line(invoice="1", stock="P2", price=4.0, date="2010-01-01 00:00:00"),
        line(invoice="2", price=3.0, date="2010-02-01 00:00:00"),
    ]
    valid = _valid(make_raw(rows))
    g = metrics.aov_global(valid).collect()[0]
    assert (g["Revenue"], g["Facturas"], g["AOV"]) == (9.0, 2, 4.5)
    m = [(r["Month"], r["AOV"]) for r in metrics.aov_monthly(valid).collect()]
    assert m == [(1, 6.0), (2, 3.0)]


def test_combine_by_key_keeps_one_sided_keys(spark):
    a = spark.createDataFrame([("x", 1.0), ("y", 2.0), (None, 3.0)], "k string, a double")
    b = spark.createDataFrame([("y", 20), ("z", 30), (None, 40)], "k string, b long")
    got = sorted(
        (tuple(r) for r in metrics.combine_by_key(a, b, "k").collect()), key=lambda t: (t[0] is None, t[0] or "")
    )
    assert got == [("x", 1.0, None), ("y", 2.0, 20), ("z", None, 30), (None, 3.0, 40)]


def test_tiers_boundary_customer_is_low(make_raw):
    # 7 customers with spend 1..7: (n - 1) / 3 = 2 exactly, so the first cut
    # lands on the 3rd customer's spend (3) and that customer is Bajo.
    rows = [line(invoice=str(i), cust=float(i), price=float(i)) for i in range(1, 8)]
    valid = _valid(make_raw(rows))
    tiers = {r["Customer ID"]: r["Tier"] for r in segments.customer_tiers(valid).collect()}
    assert [tiers[float(i)] for i in range(1, 8)] == ["Bajo"] * 3 + ["Medio"] * 2 + ["Alto"] * 2
    counts = [(r["Tier"], r["count"]) for r in segments.tier_counts(valid).collect()]
    assert counts == [("Bajo", 3), ("Medio", 2), ("Alto", 2)]


def test_tiers_interpolated_cut(make_raw):
    # n = 6: first cut at rank 5/3 -> between 2nd and 3rd values.
    rows = [line(invoice=str(i), cust=float(i), price=float(i)) for i in range(1, 7)]
    tiers = {r["Customer ID"]: r["Tier"] for r in segments.customer_tiers(_valid(make_raw(rows))).collect()}
    assert [tiers[float(i)] for i in range(1, 7)] == ["Bajo", "Bajo", "Medio", "Medio", "Alto", "Alto"]


def test_tiers_with_equal_spend(make_raw):
    rows = [line(invoice=str(i), cust=float(i), price=5.0) for i in range(1, 10)]
    tiers = {r["Tier"] for r in segments.customer_tiers(_valid(make_raw(rows))).collect()}
    assert tiers == {"Bajo"}


def test_tiers_approx_switch_agrees_on_small_input(make_raw):
    rows = [line(invoice=str(i), cust=float(i), price=float(i)) for i in range(1, 61)]
    valid = _valid(make_raw(rows))
    exact = {r["Customer ID"]: r["Tier"] for r in segments.customer_tiers(valid).collect()}
    approx = {r["Customer ID"]: r["Tier"] for r in segments.customer_tiers(valid, approx=True).collect()}
    assert sum(exact[k] != approx[k] for k in exact) <= 2


def test_tier_cuts_interpolate(make_raw):
    rows = [line(invoice=str(i), cust=float(i), price=float(i)) for i in range(1, 7)]
    cut = segments.tier_cuts(_valid(make_raw(rows))).collect()[0]
    # n = 6: ranks 5/3 and 10/3 -> 2 + 2/3 and 4 + 1/3.
    assert (cut["cut_low"], cut["cut_high"]) == (round(2 + 2 / 3, 6), round(4 + 1 / 3, 6))
