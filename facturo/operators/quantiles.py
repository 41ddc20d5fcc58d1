"""Exact order statistics and quantiles by histogram refinement, without a sort.

``percentile`` keeps every distinct value of a group in one buffer, and an
unpartitioned window sorts all rows in one task. Both break at scale. Here:

1. One aggregate gives each group's size, minimum and maximum.
2. A round counts the rows of each interval that holds a wanted rank in
   ``BUCKETS`` buckets, a pure function of the value, with the least and
   greatest value of each. Tasks add up their own rows, so a round shuffles no
   more than intervals x buckets rows a task, hot values or not. The bucket
   that holds the rank is the next interval.
3. An interval with few rows, or with one value, ends: its distinct values are
   counted and the wanted rank read off.

All groups and ranks share the scan of a round. Intervals that span more than
an e-fold are cut on a logarithmic scale, so extremes cost one round more, not
many; a double has at most six rounds. Nothing is sorted, exchanged by range or
written, and every bound is computed from exact counts, so no result rests on
a re-used exchange or on how rows were dealt.

``rank_intervals`` gives the rank interval of every distinct value, by a written
range table; it serves callers that need all ranks, or very many groups.

Quantile positions use integer arithmetic on exact fractions, so ``1/3`` of
``n - 1`` never suffers float rounding.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from fractions import Fraction
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from facturo.session import materialize

_MAX_DENOMINATOR = 10**6
_MAX_DOUBLE = 1.7976931348623157e308
#: Buckets of an interval in a round.
BUCKETS = 1024
#: Rows of an interval whose values are counted one by one.
FEW = 10_000
#: Groups that are refined side by side; more of them take the range table.
MAX_GROUPS = 64


def _fraction(p: float | Fraction) -> Fraction:
    f = p if isinstance(p, Fraction) else Fraction(p).limit_denominator(_MAX_DENOMINATOR)
    if not 0 <= f <= 1:
        raise ValueError(f"quantile out of range: {p}")
    return f


def value_counts(df: DataFrame, value: str, group: str | None = None) -> DataFrame:
    """(group?, value, _w): each distinct non-null value with its number of rows."""
    keys = [group] if group else []
    return df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_w"))


def rank_intervals(
    df: DataFrame, value: str, group: str | None = None, num_ranges: int | None = None, counted: bool = False
) -> DataFrame:
    """(group?, value, _start, _end, _n): rank interval of each distinct non-null value.

    ``counted=True`` means ``df`` already is a ``value_counts`` result.
    """
    spark = df.sparkSession
    parts = num_ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [group] if group else []
    freq = df if counted else value_counts(df, value, group)
    # Range bounds are sampled, so a second run of the exchange could cut
    # elsewhere. The ranges are therefore written once, with their numbers, and
    # both branches below read that table; a retried task reads it again.
    ranged = freq.repartitionByRange(parts, *[F.col(k) for k in keys], F.col(value)).withColumn(
        "_pid", F.spark_partition_id()
    )
    ranged = materialize(ranged, spark, "value-ranges")
    local = ranged.withColumn(
        "_cum",
        F.sum("_w").over(
            Window.partitionBy("_pid", *keys).orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ),
    )
    sizes = ranged.groupBy("_pid", *keys).agg(F.sum("_w").alias("_size"))
    offsets = sizes.select(
        "_pid",
        *keys,
        F.coalesce(
            F.sum("_size").over(
                Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
            ),
            F.lit(0),
        ).alias("_off"),
        F.sum("_size").over(Window.partitionBy(*keys)).alias("_n"),
    )
    # ``offsets`` has one row per (range partition, group) holding data; AQE
    # decides from its measured size whether to broadcast it.
    located = local.join(offsets, ["_pid", *keys])
    return located.select(
        *keys,
        F.col(value),
        (F.col("_off") + F.col("_cum") - F.col("_w")).alias("_start"),
        (F.col("_off") + F.col("_cum")).alias("_end"),
        F.col("_n"),
    )


def _lower_rank(f: Fraction) -> Column:
    """floor((n - 1) * f) in exact integer arithmetic."""
    return F.expr(f"((_n - 1) * {f.numerator}) div {f.denominator}")


def lower_rank(p: float | Fraction, n: int) -> int:
    """The 0-based rank floor((n - 1) * p) of n values, exactly."""
    f = _fraction(p)
    return (n - 1) * f.numerator // f.denominator


def _frac_part(f: Fraction) -> Column:
    """(n - 1) * f - floor((n - 1) * f), as double."""
    return F.expr(f"cast(pmod((_n - 1) * {f.numerator}, {f.denominator}) as double) / {f.denominator}")


def _value_at(value: str, rank: Column) -> Column:
    return F.max(F.when((F.col("_start") <= rank) & (rank < F.col("_end")), F.col(value)))


@dataclass(frozen=True)
class RankedValue:
    """A value and the 0-based ranks [start, end) that it has in its group."""

    value: Any
    start: int
    end: int


@dataclass
class _Interval:
    group: Any
    low: float
    high: float
    before: int
    rows: int
    ranks: list[int] = field(default_factory=list)

    @property
    def ends(self) -> bool:
        return self.rows <= FEW or self.low == self.high

    def holds(self) -> Column:
        return F.col("_g").eqNullSafe(F.lit(self.group)) & F.col("_x").between(F.lit(self.low), F.lit(self.high))

    def bucket(self) -> Column:
        """Number of the value's bucket; it never falls as the value rises."""
        x, low, high = F.col("_x"), F.lit(self.low), F.lit(self.high)
        if _log_key(self.high) - _log_key(self.low) > 1:
            x, low, high = (F.signum(c) * F.log1p(F.abs(c)) for c in (x, low, high))
        return F.floor((x - low) / (high - low) * F.lit(float(BUCKETS)))


def _log_key(x: float) -> float:
    return math.copysign(math.log1p(abs(x)), x)


def _which(intervals: list[_Interval], result: Callable[[int, _Interval], Column]) -> Column:
    out = F
    for i, interval in enumerate(intervals):
        out = out.when(interval.holds(), result(i, interval))
    return out


def select_ranks(
    df: DataFrame, value: str, wanted: Callable[[int], Iterable[int]], group: str | None = None, weight: str | None = None
) -> dict[Any, tuple[int, dict[int, RankedValue]]]:
    """For each group (None without ``group``): its size n and the values at the ranks ``wanted(n)``.

    Nulls and NaN have no rank. ``weight``: a column of row counts. Runs one
    aggregate a round; what reaches the driver is bounded by groups, ranks and
    buckets. Values are compared as doubles first; those that one double
    stands for are told apart at the end.
    """
    x = F.least(F.greatest(F.col(value).cast("double"), F.lit(-_MAX_DOUBLE)), F.lit(_MAX_DOUBLE))
    base = df.select(
        (F.col(group) if group else F.lit(None).cast("string")).alias("_g"),
        F.col(value).alias("_v"),
        x.alias("_x"),
        (F.col(weight) if weight else F.lit(1)).cast("long").alias("_w"),
    ).filter(F.col("_v").isNotNull() & ~F.isnan(F.col("_v").cast("double")))
    out: dict[Any, tuple[int, dict[int, RankedValue]]] = {}
    pending: list[_Interval] = []
    for r in base.groupBy("_g").agg(F.sum("_w").alias("n"), F.min("_x").alias("low"), F.max("_x").alias("high")).collect():
        if r["n"]:
            out[r["_g"]] = (r["n"], {})
            pending.append(_Interval(r["_g"], r["low"], r["high"], 0, r["n"], sorted({k for k in wanted(r["n"]) if 0 <= k < r["n"]})))
    ended = [i for i in pending if i.ends]
    pending = [i for i in pending if not i.ends]
    while pending:
        marked = base.withColumn("_i", _which(pending, lambda i, _: F.lit(i))).filter(F.col("_i").isNotNull())
        marked = marked.withColumn("_b", _which(pending, lambda _, interval: interval.bucket()))
        found = marked.groupBy("_i", "_b").agg(F.sum("_w").alias("n"), F.min("_x").alias("low"), F.max("_x").alias("high")).collect()
        following = []
        for i, interval in enumerate(pending):
            before, left = interval.before, list(interval.ranks)
            for r in sorted((r for r in found if r["_i"] == i), key=lambda r: r["_b"]):
                own = [k for k in left if k < before + r["n"]]
                if own:
                    following.append(_Interval(interval.group, r["low"], r["high"], before, r["n"], own))
                    left = left[len(own) :]
                before += r["n"]
        ended += [i for i in following if i.ends]
        pending = [i for i in following if not i.ends]
    if ended:
        marked = base.withColumn("_i", _which(ended, lambda i, _: F.lit(i))).filter(F.col("_i").isNotNull())
        found = marked.groupBy("_i", "_v").agg(F.sum("_w").alias("n")).collect()
        for i, interval in enumerate(ended):
            before, ranks = interval.before, out[interval.group][1]
            for r in sorted((r for r in found if r["_i"] == i), key=lambda r: r["_v"]):
                ranks |= {k: RankedValue(r["_v"], before, before + r["n"]) for k in interval.ranks if before <= k < before + r["n"]}
                before += r["n"]
    return out


def _few_groups(df: DataFrame, group: str | None) -> bool:
    return group is None or df.select(group).distinct().limit(MAX_GROUPS + 1).count() <= MAX_GROUPS


def order_statistics(
    df: DataFrame, value: str, probs: list[float], names: list[str], group: str | None = None
) -> DataFrame:
    """Per group (or one row): the value at 0-based rank floor((n - 1) * p), for each p."""
    if not _few_groups(df, group):
        intervals = rank_intervals(df, value, group)
        return intervals.groupBy(group).agg(*[_value_at(value, _lower_rank(_fraction(p))).alias(name) for p, name in zip(probs, names)])
    fractions = [_fraction(p) for p in probs]
    found = select_ranks(df, value, lambda n: [lower_rank(f, n) for f in fractions], group)
    rows = [(g, *[ranks[lower_rank(f, n)].value for f in fractions]) for g, (n, ranks) in found.items()]
    return _result(df, rows, group, names, df.schema[value].dataType)


def _result(df: DataFrame, rows: list[tuple], group: str | None, names: list[str], kind: T.DataType) -> DataFrame:
    """Rows of (group, values): one a group, or one in all, of nulls on empty input."""
    fields = [T.StructField(name, kind) for name in names]
    if group:
        return df.sparkSession.createDataFrame(rows, T.StructType([df.schema[group], *fields]))
    rows = [r[1:] for r in rows] or [(None,) * len(names)]
    return df.sparkSession.createDataFrame(rows, T.StructType(fields))


def exact_quantiles(
    df: DataFrame,
    value: str,
    probs: list[float],
    names: list[str],
    group: str | None = None,
    counted: bool = False,
) -> DataFrame:
    """Linearly interpolated quantiles (the ``(n - 1) * p`` rule) as double.

    Equal to ``percentile``, ``quantile_cont`` and pandas ``quantile``; NaN is
    no value. One row per group, or one row in all (null on empty input)
    without a group. ``counted=True`` means ``df`` already is a
    ``value_counts`` result.
    """
    fractions = [_fraction(p) for p in probs]
    if _few_groups(df, group):
        found = select_ranks(
            df, value, lambda n: [k for f in fractions for k in (lower_rank(f, n), min(lower_rank(f, n) + 1, n - 1))], group, "_w" if counted else None
        )
        rows = []
        for g, (n, ranks) in found.items():
            row = [g]
            for f in fractions:
                part = (n - 1) * f.numerator % f.denominator / f.denominator
                low, high = (float(ranks[k].value) for k in (lower_rank(f, n), min(lower_rank(f, n) + 1, n - 1)))
                row.append(low if part == 0 else low + (high - low) * part)
            rows.append(tuple(row))
        return _result(df, rows, group, names, T.DoubleType())
    intervals = rank_intervals(df, value, group, counted=counted)
    aggs, finals = [], []
    for i, (f, name) in enumerate(zip(fractions, names)):
        lo = _lower_rank(f)
        hi = F.least(lo + F.lit(1), F.col("_n") - F.lit(1))
        aggs += [
            _value_at(value, lo).cast("double").alias(f"_lo{i}"),
            _value_at(value, hi).cast("double").alias(f"_hi{i}"),
            F.max(_frac_part(f)).alias(f"_fr{i}"),
        ]
        lo_v, hi_v, fr = F.col(f"_lo{i}"), F.col(f"_hi{i}"), F.col(f"_fr{i}")
        finals.append(F.when(fr == 0, lo_v).otherwise(lo_v + (hi_v - lo_v) * fr).alias(name))
    return intervals.groupBy(group).agg(*aggs).select(group, *finals)
