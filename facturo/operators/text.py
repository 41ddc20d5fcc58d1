"""Text extracts and word-length statistics; per-customer ordered quantities.

The word jobs tokenise whole descriptions on whitespace with ``split`` +
``explode`` and aggregate straight away, so the exploded words never travel:
partial aggregation folds them per task into one row per length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from facturo.functions import strip_blanks, whole_number_text, word_tokens
from facturo.operators.ordering import secondary_sort
from facturo.schema import CUSTOMER_ID, DESCRIPTION, QUANTITY

LINE = "value"


def description_lines(raw: DataFrame, *, column: str = DESCRIPTION) -> DataFrame:
    """One stripped, non-empty description per row (column ``value``)."""
    stripped = strip_blanks(column)
    return raw.select(stripped.alias(LINE)).filter(F.col(LINE).isNotNull() & (F.col(LINE) != ""))


def customer_quantity_pairs(
    raw: DataFrame, *, customer: str = CUSTOMER_ID, quantity: str = QUANTITY
) -> DataFrame:
    """(customer_id long, quantity int) for lines with both values; sign kept."""
    return raw.filter(F.col(customer).isNotNull() & F.col(quantity).isNotNull()).select(
        whole_number_text(customer).alias("customer_id"),
        whole_number_text(quantity).cast("int").alias("quantity"),
    )


def words(lines: DataFrame, *, column: str = LINE) -> DataFrame:
    """One row per whitespace-separated word (column ``word``)."""
    return lines.select(F.explode(word_tokens(column)).alias("word"))


def word_length_hist(lines: DataFrame, *, column: str = LINE) -> DataFrame:
    """Number of words of each length (``length`` int, ``count`` long)."""
    return (
        words(lines, column=column)
        .groupBy(F.length("word").alias("length"))
        .agg(F.count(F.lit(1)).cast("long").alias("count"))
        .orderBy("length")
    )


def word_mean(lines: DataFrame, *, column: str = LINE) -> DataFrame:
    """Word count, total length and mean length, one row."""
    w = words(lines, column=column)
    return w.agg(
        F.count(F.lit(1)).cast("long").alias("count"),
        F.coalesce(F.sum(F.length("word")), F.lit(0)).cast("long").alias("length"),
    ).withColumn("mean", F.try_divide(F.col("length").cast("double"), F.col("count").cast("double")))


def word_median(lines: DataFrame, *, column: str = LINE) -> DataFrame:
    """Smallest word length whose running count reaches half of all words.

    The running sum is an unpartitioned window, but over the length histogram
    (one row per distinct length), not over words.
    """
    hist = (
        words(lines, column=column)
        .groupBy(F.length("word").alias("length"))
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    running_sum = Window.orderBy("length").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = hist.select(
        "length",
        F.sum("_c").over(running_sum).alias("_cum"),
        F.sum("_c").over(Window.partitionBy()).alias("_total"),
    )
    return running.agg(F.min(F.when(F.col("_cum") * 2 >= F.col("_total"), F.col("length"))).alias("median_length"))


def customer_quantity_sorted(pairs: DataFrame) -> DataFrame:
    """Quantities ascending within each customer, customers ascending."""
    return secondary_sort(pairs, "customer_id", "quantity")
