"""Top-k and ordered output.

``top_k`` keeps ``orderBy`` and ``limit`` adjacent so the planner uses
TakeOrderedAndProject: every task keeps its own k best rows and only k rows
per task travel to the final merge; the input is never fully sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def top_k(
    df: DataFrame,
    metric: str,
    tie_break: list[str] | str,
    n: int = 10,
    output: list[str | Column] | None = None,
) -> DataFrame:
    """The ``n`` rows with the largest ``metric``; ties go to the smallest keys."""
    keys = [tie_break] if isinstance(tie_break, str) else list(tie_break)
    order = [F.col(metric).desc_nulls_last()] + [F.col(k).asc_nulls_last() for k in keys]
    ranked = df.orderBy(*order).limit(n)
    return ranked.select(*output) if output else ranked


EXPAND_CHUNK = 10_000
# Base and number of digits of a chunk number: 4096 ** 4 chunks of one copy
# or more are above any count.
CHUNK_FANOUT, CHUNK_LEVELS = 4096, 4


def chunk_counts(df: DataFrame, count: str, chunk: int = EXPAND_CHUNK) -> DataFrame:
    """Split each row's ``count`` into chunks of at most ``chunk`` copies.

    Output: the other columns, ``_chunk`` (0-based chunk number) and ``_k``
    (copies in that chunk). A group of any size becomes many small rows that
    the next shuffle can spread over tasks. Chunk numbers are made digit by
    digit, so no array has more than ``CHUNK_FANOUT`` elements.
    """
    cols = [c for c in df.columns if c != count]
    zero = F.lit(0).cast("long")
    chunks = df.where(F.col(count) > 0).select(*cols, F.col(count).cast("long").alias("_n"), zero.alias("_chunk"))
    for level in reversed(range(CHUNK_LEVELS)):
        step = CHUNK_FANOUT**level
        last = F.least(F.expr(f"(_n - 1) div {chunk} - _chunk") / step, F.lit(CHUNK_FANOUT - 1))
        digit = F.explode(F.sequence(zero, F.floor(last).cast("long"))).alias("_digit")
        chunks = chunks.select(*cols, "_n", "_chunk", digit).select(
            *cols, "_n", (F.col("_chunk") + F.col("_digit") * step).alias("_chunk")
        )
    size = F.least(F.lit(chunk).cast("long"), F.col("_n") - F.col("_chunk") * chunk)
    return chunks.select(*cols, "_chunk", size.alias("_k"))


def expand_chunks(df: DataFrame) -> DataFrame:
    """Turn ``chunk_counts`` rows back into one row per copy, in place (order kept)."""
    cols = [c for c in df.columns if c not in ("_chunk", "_k")]
    return df.select(*cols, F.explode(F.sequence(F.lit(1).cast("long"), F.col("_k"))).alias("_copy")).select(*cols)


def secondary_sort(df: DataFrame, group: str, value: str, chunk: int = EXPAND_CHUNK) -> DataFrame:
    """Rows grouped by ``group`` with ``value`` ascending inside each group.

    Identical (group, value) pairs are indistinguishable, so the sorted output
    is fixed by their counts: pairs are counted (partial aggregation folds a
    hot pair map-side), big counts are cut into chunks, the distinct
    (group, value, chunk) rows are globally sorted (range partitioning splits
    even a group holding a third of all rows, chunk by chunk) and each chunk
    is expanded in place. Deterministic, so a retried task after an executor
    loss reproduces exactly the same rows; read back in order, the part files
    are the sorted result.
    """
    counts = df.groupBy(group, value).agg(F.count(F.lit(1)).alias("_n"))
    ordered = chunk_counts(counts, "_n", chunk).orderBy(
        F.col(group).asc_nulls_last(), F.col(value).asc_nulls_last(), F.col("_chunk")
    )
    return expand_chunks(ordered)
