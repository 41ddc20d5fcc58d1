"""Data-quality and exploration profile of the raw invoice lines.

Per-column measures are computed in one pass and unpivoted into long form
(one row per column), instead of one scan per column. Counting by value uses
``groupBy`` with partial aggregation, never ``mode``/``collect_list``.
Group keys that are null are dropped in the raw listings, as pandas does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from facturo.functions import (
    as_money_double,
    is_cancelled,
    line_total,
    month_end,
    parse_timestamp,
    rounded_percent,
)
from facturo.operators.ordering import EXPAND_CHUNK, chunk_counts, expand_chunks, top_k
from facturo.operators.quantiles import exact_quantiles
from facturo.schema import (
    COUNTRY,
    CUSTOMER_ID,
    DESCRIPTION,
    INVOICE,
    INVOICE_DATE,
    PRICE,
    QUANTITY,
    REVENUE,
    STOCK_CODE,
    TEXT_COLUMNS,
)

# The quantiles of a numeric description.
DESCRIBE_PROBS = [0.25, 0.5, 0.75]
DESCRIBE_NAMES = ["p25", "p50", "p75"]
STAT_DECIMALS = 6


def _unpivot(one_row: DataFrame, columns: list[str], measures: list[str]) -> DataFrame:
    """One-row frame with ``{measure}__{column}`` fields -> one row per column."""
    structs = [
        F.struct(F.lit(c).alias("column"), *[F.col(f"{m}__{c}").alias(m) for m in measures]) for c in columns
    ]
    return one_row.select(F.inline(F.array(*structs)))


def profile_schema(raw: DataFrame) -> DataFrame:
    """Shape and per-column type and non-null count (``shape`` + ``info``)."""
    cols = raw.columns
    counts = raw.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(c)).alias(f"non_null__{c}") for c in cols]
    )
    for c in cols:
        counts = counts.withColumn(f"type__{c}", F.lit(raw.schema[c].dataType.simpleString()))
        counts = counts.withColumn(f"rows__{c}", F.col("_rows"))
    return _unpivot(counts, cols, ["type", "non_null", "rows"]).select(
        "column", "type", F.col("non_null").cast("long"), F.col("rows").cast("long")
    )


def profile_nulls(raw: DataFrame) -> DataFrame:
    """Nulls per column and their share of rows in %, rounded to 2 places."""
    cols = raw.columns
    counts = raw.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(f"nulls__{c}") for c in cols]
    )
    for c in cols:
        counts = counts.withColumn(f"pct__{c}", rounded_percent(f"nulls__{c}", "_rows"))
    return _unpivot(counts, cols, ["nulls", "pct"]).select("column", F.col("nulls").cast("long"), "pct")


def _row_groups(raw: DataFrame) -> DataFrame:
    return raw.groupBy(*raw.columns).agg(F.count(F.lit(1)).alias("_n"))


def profile_duplicates(raw: DataFrame) -> DataFrame:
    """Surplus copies (all but the first of each group) and rows in duplicate groups."""
    return _row_groups(raw).agg(
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("duplicates"),
        F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n")).otherwise(0)), F.lit(0))
        .cast("long")
        .alias("rows_in_duplicate_groups"),
        F.count_if(F.col("_n") > 1).cast("long").alias("duplicate_groups"),
    )


def duplicate_rows(raw: DataFrame, n: int | None = 10) -> DataFrame:
    """Every member of each duplicate group, in a total order (first ``n``, or all).

    Groups are found by aggregation, not by a window over all columns, so a
    group of copies holding a third of the table never lands in one task. With
    ``n`` set, at most ``n`` groups and ``n`` copies of each are expanded.
    """
    cols = raw.columns
    order = [F.col(c).asc_nulls_last() for c in cols]
    groups = _row_groups(raw).filter(F.col("_n") > 1)
    if n is not None:
        top = groups.orderBy(*order).limit(n)
        members = top.select(*cols, F.explode(F.sequence(F.lit(1), F.least("_n", F.lit(n)).cast("int"))))
        return members.orderBy(*order).limit(n).select(*cols)
    return expand_counts(groups, "_n").orderBy(*order).select(*cols)


def expand_counts(df: DataFrame, count: str, chunk: int = EXPAND_CHUNK) -> DataFrame:
    """Repeat each row ``count`` times, without one task writing a huge group.

    Each row first becomes ceil(count / chunk) chunk rows, which a round-robin
    repartition spreads over all tasks; each chunk then yields at most
    ``chunk`` copies.
    """
    chunks = chunk_counts(df, count, chunk)
    return expand_chunks(chunks.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))


def profile_cardinality(raw: DataFrame, columns: list[str] | None = None, approx: bool = False) -> DataFrame:
    """Distinct non-null values per column (long form, one row per column).

    One global aggregate: Spark plans several exact distinct counts as one
    expanded two-level aggregate keyed by (column, value), so a single scan
    and shuffle serve all columns and a hot value is folded map-side. With
    ``approx=True`` each column gets a HyperLogLog++ sketch instead: no
    shuffle of values at all, about 1 % relative error.
    """
    columns = columns or [COUNTRY, INVOICE, CUSTOMER_ID, STOCK_CODE]
    if approx:
        aggs = [F.approx_count_distinct(F.col(c), 0.01).cast("long").alias(f"distinct__{c}") for c in columns]
    else:
        aggs = [F.countDistinct(F.col(c)).cast("long").alias(f"distinct__{c}") for c in columns]
    return _unpivot(raw.agg(*aggs), columns, ["distinct"])


def profile_numeric(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """count, mean, sample std, min, quartiles, max per numeric column (long form).

    The columns become (column, value) pairs. One aggregate gives count, mean,
    std (a numerically stable moment), min and max; the quartiles come from
    histogram rounds over the same pairs (``quantiles.select_ranks``), so no
    value is shuffled, sorted or written. NaN is no value. Mean, std and
    quartiles are rounded to 6 places (the last bit of a floating sum or
    interpolation differs between engines). Every column keeps its row, even
    when it has no value.
    """
    columns = columns or [QUANTITY, PRICE]
    long = df.select(
        F.inline(
            F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])
        )
    ).withColumn("value", F.when(~F.isnan("value"), F.col("value")))
    # A row without value per column (names only) keeps empty columns present.
    names = df.sparkSession.createDataFrame([(c, None) for c in columns], "column string, value double")
    first = (
        long.unionByName(names)
        .groupBy("column")
        .agg(
            F.count("value").cast("long").alias("count"),
            F.avg("value").alias("_mean"),
            F.stddev_samp("value").alias("_std"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
        )
    )
    # one row per profiled column: a proven bound
    quartiles = exact_quantiles(long, "value", DESCRIBE_PROBS, DESCRIBE_NAMES, group="column")
    return first.join(F.broadcast(quartiles), "column", "left").select(
        "column",
        "count",
        F.round("_mean", STAT_DECIMALS).alias("mean"),
        F.round("_std", STAT_DECIMALS).alias("std"),
        "min",
        *[F.round(q, STAT_DECIMALS).alias(q) for q in DESCRIBE_NAMES],
        "max",
    )


def profile_numeric_all(raw: DataFrame) -> DataFrame:
    """Numeric half of a describe over every numeric column of the table."""
    kinds = ("short", "integer", "long", "float", "double", "decimal")
    numeric = [f.name for f in raw.schema.fields if f.dataType.typeName() in kinds]
    return profile_numeric(raw, numeric)


def profile_text(raw: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """count, unique, most frequent value and its frequency per text column.

    Ties for the most frequent value go to the smallest value. A column with
    no value at all still gets its row (count 0, unique 0, no top value).
    """
    columns = columns or TEXT_COLUMNS
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast(StringType()).alias("value")) for c in columns]
    long = raw.select(F.inline(F.array(*pairs)))
    freq = long.filter(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("_f"))
    # One zero-weight row per column (names only) keeps every column present,
    # even when it has no value at all or the table is empty; no join needed.
    names = raw.sparkSession.createDataFrame([(c, None, 0) for c in columns], "column string, value string, _f long")
    present = F.col("_f") > 0
    return (
        freq.unionByName(names)
        .groupBy("column")
        .agg(
            F.sum("_f").cast("long").alias("count"),
            F.count_if(present).cast("long").alias("unique"),
            F.min_by("value", F.when(present, F.struct((-F.col("_f")).alias("f"), F.col("value").alias("v")))).alias(
                "top"
            ),
            F.max(F.when(present, F.col("_f"))).cast("long").alias("freq"),
        )
    )


def profile_cancelled(raw: DataFrame, *, invoice: str = INVOICE, column: str = QUANTITY) -> DataFrame:
    """Cancelled lines (invoice text starts with C) and a description of their quantity."""
    cancelled = raw.filter(is_cancelled(F.col(invoice).cast(StringType())))
    return profile_numeric(cancelled, [column])


def profile_invalid(raw: DataFrame, *, quantity: str = QUANTITY, price: str = PRICE) -> DataFrame:
    """Rows with negative quantity and rows with price <= 0."""
    return raw.agg(
        F.count_if(F.col(quantity) < 0).cast("long").alias("negative_quantity"),
        F.count_if(F.col(price) <= 0).cast("long").alias("non_positive_price"),
    )


def time_range(raw: DataFrame, *, date: str = INVOICE_DATE) -> DataFrame:
    """Earliest and latest parsed invoice time."""
    ts = parse_timestamp(date)
    return raw.agg(F.min(ts).alias("first_time"), F.max(ts).alias("last_time"))


def country_counts(raw: DataFrame, *, key: str = COUNTRY, n: int = 10) -> DataFrame:
    """Most frequent values of a column (null dropped), top ``n``."""
    counts = raw.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).cast("long").alias("count"))
    return top_k(counts, "count", key, n)


def monthly_line_counts(raw: DataFrame, *, date: str = INVOICE_DATE) -> DataFrame:
    """Lines per calendar month, labelled by month end, empty months as 0.

    Months come from a grouped count (one row per month). Each month present
    also yields the empty ones up to the next, found by a window over that
    small result: one scan, no join.
    """
    ts = parse_timestamp(date)
    monthly = (
        raw.select(month_end(ts).alias("month_end"))
        .filter(F.col("month_end").isNotNull())
        .groupBy("month_end")
        .agg(F.count(F.lit(1)).cast("long").alias("_lines"))
    )
    start = F.trunc("month_end", "month")
    following = F.lead("month_end").over(Window.orderBy("month_end"))
    last = F.coalesce(F.add_months(F.trunc("_next", "month"), -1), start)
    filled = monthly.withColumn("_next", following).select(
        "month_end", "_lines", F.posexplode(F.sequence(start, last, F.expr("INTERVAL 1 MONTH"))).alias("_gap", "_start")
    )
    return filled.select(
        F.last_day("_start").alias("month_end"),
        F.when(F.col("_gap") == 0, F.col("_lines")).otherwise(0).cast("long").alias("lines"),
    ).orderBy("month_end")


def raw_top_products(raw: DataFrame, *, key: str = DESCRIPTION, n: int = 10) -> DataFrame:
    """Units per product over raw lines (no cleaning), top ``n``."""
    sums = raw.filter(F.col(key).isNotNull()).groupBy(key).agg(F.sum(QUANTITY).cast("long").alias(QUANTITY))
    return top_k(sums, QUANTITY, key, n)


def raw_top_customers(raw: DataFrame, *, key: str = CUSTOMER_ID, n: int = 10) -> DataFrame:
    """Revenue per customer over raw lines (no cleaning), top ``n``."""
    sums = (
        raw.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.sum(line_total(QUANTITY, PRICE)).alias("_rev"))
    )
    return top_k(sums, "_rev", key, n, [F.col(key), as_money_double("_rev").alias(REVENUE)])


def gross_revenue(raw: DataFrame) -> DataFrame:
    """Revenue of lines with positive quantity (conditional sum)."""
    return raw.agg(
        as_money_double(F.sum(F.when(F.col(QUANTITY) > 0, line_total(QUANTITY, PRICE)))).alias("gross_revenue")
    )


def mean_invoice_value(raw: DataFrame, *, key: str = INVOICE) -> DataFrame:
    """Mean over invoices of the invoice total (null invoice dropped)."""
    per_invoice = (
        raw.filter(F.col(key).isNotNull()).groupBy(key).agg(F.sum(line_total(QUANTITY, PRICE)).alias("_total"))
    )
    return per_invoice.agg(
        F.try_divide(as_money_double(F.sum("_total")), F.count("_total").cast("double")).alias("mean_invoice_value")
    )
