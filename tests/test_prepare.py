from __future__ import annotations

import datetime as dt
from decimal import Decimal

from conftest import line

from facturo.operators import prepare


def test_clean_drops_null_description_and_non_positive_price(make_raw):
    raw = make_raw(
        [
            line(desc=None),
            line(price=0.0),
            line(price=-1.0),
            line(price=None),
            line(desc="   "),  # blank text is not null: kept
            line(),
        ]
    )
    assert prepare.clean_rows(raw).count() == 2


def test_dedup_treats_nulls_as_equal(make_raw):
    raw = make_raw([line(cust=None), line(cust=None), line(cust=2.0), line()])
    assert prepare.dedup_rows(raw).count() == 3


def test_derive_parses_dates_and_flags_cancellations(make_raw):
    raw = make_raw(
        [
            line(invoice="C9", qty=-2, price=1.25),
            line(invoice=None, date="not a date"),
            line(invoice="", date="2011-12-09 12:50:00", qty=3, price=0.333),
        ]
    )
    rows = {r["Invoice"]: r for r in prepare.derive_columns(raw).collect()}
    c = rows["C9"]
    assert c["IsCancelled"] is True
    assert c["TotalPrice"] == Decimal("-2.5000")
    assert c["InvoiceDate"] == dt.datetime(2010, 1, 5, 10, 0)
    assert (c["Year"], c["Month"]) == (2010, 1)
    bad = rows[None]
    assert bad["InvoiceDate"] is None and bad["Year"] is None and bad["IsCancelled"] is None
    empty = rows[""]
    assert empty["IsCancelled"] is False
    assert empty["TotalPrice"] == Decimal("0.9990")


def test_valid_drops_null_cancellation_flag(make_raw):
    raw = make_raw([line(invoice=None), line(invoice="C1"), line(qty=0), line(qty=-1), line()])
    derived = prepare.derive_columns(raw)
    assert prepare.valid_rows(derived).count() == 1


def test_stage_counts_equal_separate_passes(make_raw):
    rows = [line(), line(), line(desc=None), line(desc=None), line(invoice="C2"), line(invoice="C2"), line(qty=-3)]
    raw = make_raw(rows)
    got = prepare.stage_counts(raw).collect()[0].asDict()
    s = prepare.prepared_stages(raw)
    assert {k: got[k] for k in ("rows_raw", "rows_clean", "rows_dedup", "rows_valid")} == {
        "rows_raw": raw.count(),
        "rows_clean": s["clean"].count(),
        "rows_dedup": s["dedup"].count(),
        "rows_valid": s["valid"].count(),
    }
    assert got == {"rows_raw": 7, "rows_clean": 5, "rows_dedup": 3, "rows_valid": 1, "removed_clean": 2, "removed_duplicates": 2}


def test_empty_input_gives_empty_or_zero_results(make_raw):
    raw = make_raw([])
    assert prepare.prepared_stages(raw)["valid"].count() == 0
    counts = prepare.stage_counts(raw).collect()[0].asDict()
    assert counts == {"rows_raw": 0, "rows_clean": 0, "rows_dedup": 0, "rows_valid": 0, "removed_clean": 0, "removed_duplicates": 0}
    from facturo.operators import metrics, profile, segments

    valid = prepare.prepared_stages(raw)["valid"]
    assert metrics.top_products_revenue(valid).count() == 0
    assert segments.tier_counts(valid).count() == 0
    assert metrics.monthly_revenue(valid).count() == 0
    dups = profile.profile_duplicates(raw).collect()[0]
    assert (dups["duplicates"], dups["rows_in_duplicate_groups"], dups["duplicate_groups"]) == (0, 0, 0)
    assert profile.monthly_line_counts(raw).count() == 0
    g = metrics.aov_global(valid).collect()[0]
    assert g["Facturas"] == 0 and g["AOV"] is None


def test_derived_sample_is_ordered(make_raw):
    raw = make_raw([line(invoice=str(i)) for i in range(9, 0, -1)])
    sample = prepare.derived_sample(prepare.derive_columns(raw), n=3).collect()
    assert [r["Invoice"] for r in sample] == ["1", "2", "3"]
