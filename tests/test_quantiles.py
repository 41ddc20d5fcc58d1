from __future__ import annotations

import random

import numpy as np
import pytest

from facturo.operators.quantiles import exact_quantiles, order_statistics, select_ranks

PROBS = [0.0, 0.25, 1 / 3, 0.5, 2 / 3, 0.75, 1.0]
NAMES = [f"q{i}" for i in range(len(PROBS))]


def _numpy(values, p):
    return float(np.quantile(np.array(values, dtype=float), p, method="linear"))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_matches_numpy_with_ties_and_hot_value(spark, seed):
    rnd = random.Random(seed)
    values = [rnd.randint(-50, 50) for _ in range(400)] + [7] * 300  # one value holds ~40 %
    df = spark.createDataFrame([(v,) for v in values], "x int")
    got = exact_quantiles(df, "x", PROBS, NAMES).collect()[0]
    for p, name in zip(PROBS, NAMES):
        assert got[name] == pytest.approx(_numpy(values, p), abs=1e-9), (p, name)


def test_grouped_quantiles(spark):
    rows = [("a", float(v)) for v in range(1, 11)] + [("b", float(v)) for v in (5, 5, 5, 100)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {r["g"]: r for r in exact_quantiles(df, "x", [0.5, 0.75], ["med", "p75"], group="g").collect()}
    assert got["a"]["med"] == pytest.approx(5.5) and got["a"]["p75"] == pytest.approx(7.75)
    assert got["b"]["med"] == 5.0 and got["b"]["p75"] == pytest.approx(28.75)


def test_nulls_ignored_and_empty_gives_null(spark):
    df = spark.createDataFrame([(None,), (3,), (1,), (None,)], "x int")
    assert exact_quantiles(df, "x", [0.5], ["m"]).collect()[0]["m"] == 2.0
    empty = spark.createDataFrame([], "x int")
    assert exact_quantiles(empty, "x", [0.5], ["m"]).collect()[0]["m"] is None


def test_order_statistics_are_lower_neighbours(spark):
    values = list(range(100, 0, -1))
    df = spark.createDataFrame([(v,) for v in values], "x int")
    got = order_statistics(df, "x", [1 / 3, 2 / 3], ["a", "b"]).collect()[0]
    # n = 100: ranks floor(99/3) = 33 and floor(198/3) = 66 (0-based).
    assert (got["a"], got["b"]) == (34, 67)


def test_more_ranges_than_values(spark):
    df = spark.createDataFrame([(5,), (1,)], "x int")
    from facturo.operators.quantiles import rank_intervals

    rows = sorted((r["x"], r["_start"], r["_end"], r["_n"]) for r in rank_intervals(df, "x", num_ranges=16).collect())
    assert rows == [(1, 0, 1, 2), (5, 1, 2, 2)]


@pytest.mark.parametrize("reuse", ["true", "false"])
def test_ranks_do_not_rest_on_exchange_reuse(spark, reuse):
    # many distinct values, a heavy tail and a hot value
    df = spark.range(400_000).selectExpr("if(id % 3 = 0, 7L, (id * 2654435761) % 1000000007) as x")
    wanted = np.quantile([7 if i % 3 == 0 else i * 2654435761 % 1000000007 for i in range(400_000)], [0.25, 0.5, 0.75], method="lower")
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        got = order_statistics(df, "x", [0.25, 0.5, 0.75], ["a", "b", "c"]).collect()[0]
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
    assert [got["a"], got["b"], got["c"]] == wanted.tolist()


def test_refinement_over_extremes_infinities_and_nan(spark):
    rnd = random.Random(9)
    values = [rnd.uniform(-1, 1) * 10 ** rnd.randint(-300, 300) for _ in range(15_000)] + [rnd.gauss(0, 1) for _ in range(25_000)]
    values += [0.0] * 500 + [float("inf"), float("-inf"), 1.7976931348623157e308, 5e-324, -5e-324] + [1.0 + i * 2.0**-52 for i in range(12_000)]
    df = spark.createDataFrame([(v,) for v in values] + [(float("nan"),), (None,)], "x double")
    ordered = sorted(values)
    ranks = [0, 1, 7, 26_000, 31_000, len(values) // 3, len(values) - 2, len(values) - 1]
    ((n, found),) = select_ranks(df, "x", lambda n: ranks).values()
    assert n == len(values)
    for k in ranks:
        assert found[k].value == ordered[k] and found[k].start <= k < found[k].end
        assert found[k].end - found[k].start == ordered.count(ordered[k])


def test_decimals_that_share_a_double_are_told_apart(spark):
    df = spark.range(12_000).selectExpr("cast(concat('12345678901234567890123.', lpad(id % 3000, 4, '0')) as decimal(38,4)) as x")
    got = order_statistics(df, "x", [0.0, 0.5, 1.0], ["a", "b", "c"]).first()
    assert [str(got[c])[-4:] for c in "abc"] == ["0000", "1499", "2999"]


def test_no_sort_no_range_exchange_and_nothing_written(spark, monkeypatch):
    from facturo.operators import quantiles

    monkeypatch.setattr(quantiles, "materialize", lambda *a: pytest.fail("a table was written"))
    plans = []
    taken = type(spark.range(0)).collect
    monkeypatch.setattr(type(spark.range(0)), "collect", lambda self: plans.append(self._jdf.queryExecution().executedPlan().toString()) or taken(self))
    df = spark.range(100_000).selectExpr("cast(id % 60000 as double) as x", "cast(id % 3 as string) as g")
    exact_quantiles(df, "x", [0.25, 0.5], ["a", "b"], group="g")
    assert len(plans) >= 3
    assert all("rangepartitioning" not in p and "Sort " not in p for p in plans)


def test_many_groups_take_the_range_table(spark):
    df = spark.range(3000).selectExpr("id % 300 as g", "cast(id div 300 as double) as x")
    got = exact_quantiles(df, "x", [0.5], ["m"], group="g").collect()
    assert len(got) == 300 and {r["m"] for r in got} == {4.5}
