"""Q11: customer spend tiers by terciles, and tier counts.

Rule: cut points are the interpolated 1/3 and 2/3 quantiles of per-customer
spend; a customer is Bajo when spend <= first cut, Medio when <= second cut,
else Alto. Because an interpolated cut lies between two neighbouring
customer totals, ``spend <= cut`` is the same test as ``spend <= v`` where v
is the lower neighbour (the value at rank floor((n - 1) * p)). So the cuts are
exact order statistics and no interpolation arithmetic can move a customer.
The two cuts reach the per-customer rows as one scalar subquery (a struct of
both values), not as a join; the tier counts need no per-customer pass at all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facturo.functions import as_money_double
from facturo.operators.quantiles import exact_quantiles, lower_rank, order_statistics, select_ranks
from facturo.schema import CUSTOMER_ID, TOTAL_PRICE
from facturo.session import materialize

# Tier labels, from lowest to highest spend.
TIER_LOW, TIER_MID, TIER_HIGH = "Bajo", "Medio", "Alto"
TIER = "Tier"
TIER_PROBS = [1 / 3, 2 / 3]
APPROX_ACCURACY = 10_000
CUT_DECIMALS = 6


def customer_spend(valid: DataFrame, *, key: str = CUSTOMER_ID) -> DataFrame:
    """Exact (decimal) spend per known customer."""
    return valid.filter(F.col(key).isNotNull()).groupBy(key).agg(F.sum(TOTAL_PRICE).alias("_spend"))


def _written_spend(valid: DataFrame, key: str) -> DataFrame:
    """The spend per customer, written once: the rounds that find the cuts and the labels read it."""
    return materialize(customer_spend(valid, key=key), valid.sparkSession, "customer-spend")


def customer_tiers(valid: DataFrame, *, key: str = CUSTOMER_ID, approx: bool = False) -> DataFrame:
    """One row per known customer: id, spend (double) and tier label.

    ``approx=True`` takes the cuts from ``percentile_approx`` (one pass, fixed
    memory per task, rank error about 1/10000 of the customers) instead of
    the exact order statistics.
    """
    spend = customer_spend(valid, key=key) if approx else _written_spend(valid, key)
    if approx:
        cuts = spend.agg(
            F.percentile_approx("_spend", TIER_PROBS, APPROX_ACCURACY).alias("_q")
        ).select(F.col("_q")[0].alias("_c1"), F.col("_q")[1].alias("_c2"))
    else:
        cuts = order_statistics(spend, "_spend", TIER_PROBS, ["_c1", "_c2"])
    # One scalar subquery (a struct of both cuts), bound once as a column.
    cut = cuts.select(F.struct("_c1", "_c2")).scalar()
    c1, c2 = F.col("_cut._c1"), F.col("_cut._c2")
    tier = F.when(F.col("_spend") <= c1, TIER_LOW).when(F.col("_spend") <= c2, TIER_MID).otherwise(TIER_HIGH)
    return spend.withColumn("_cut", cut).select(
        F.col(key), as_money_double("_spend").alias(TOTAL_PRICE), tier.alias(TIER)
    )


def tier_cuts(valid: DataFrame, *, key: str = CUSTOMER_ID) -> DataFrame:
    """The two interpolated tercile cuts of per-customer spend, one row.

    Rounded to 6 places: the interpolation's last bit differs between engines.
    Tier labels never depend on that rounding (see ``customer_tiers``).
    """
    spend = _written_spend(valid, key).select(as_money_double("_spend").alias("_spend"))
    cuts = exact_quantiles(spend, "_spend", TIER_PROBS, ["_low", "_high"])
    return cuts.select(
        F.round("_low", CUT_DECIMALS).alias("cut_low"), F.round("_high", CUT_DECIMALS).alias("cut_high")
    )


def tier_rank(c: str = TIER):
    return F.when(F.col(c) == TIER_LOW, 0).when(F.col(c) == TIER_MID, 1).otherwise(2)


def tier_counts(valid: DataFrame, *, key: str = CUSTOMER_ID, approx: bool = False) -> DataFrame:
    """Customers per tier, ordered low, medium, high (tiers without customers omitted).

    Exact path without labelling each customer: the customers at or below a
    cut value v are exactly the ranks below the end of v's rank interval.
    """
    if approx:
        tiers = customer_tiers(valid, key=key, approx=True)
        return tiers.groupBy(TIER).agg(F.count(F.lit(1)).alias("count")).orderBy(tier_rank())
    found = select_ranks(_written_spend(valid, key), "_spend", lambda n: [lower_rank(p, n) for p in TIER_PROBS])
    rows = []
    for n, ranks in found.values():
        ends = [0, *[ranks[lower_rank(p, n)].end for p in TIER_PROBS], n]
        rows = [(tier, b - a) for tier, a, b in zip([TIER_LOW, TIER_MID, TIER_HIGH], ends, ends[1:]) if b > a]
    return valid.sparkSession.createDataFrame(rows, f"{TIER} string, count long").orderBy(tier_rank())
