"""Scalar column expressions shared by the operators.

All of them are built-in Spark expressions, so they stay inside whole-stage
code generation; none is a Python UDF.
"""

from facturo.functions.columns import (
    as_money_double,
    count_true,
    is_cancelled,
    line_total,
    month_end,
    null_safe_ratio,
    parse_timestamp,
    percent_of,
    percent_change,
    rounded_percent,
    strip_blanks,
    whole_number_text,
    without_total,
    word_tokens,
)

__all__ = [
    "as_money_double",
    "count_true",
    "is_cancelled",
    "line_total",
    "month_end",
    "null_safe_ratio",
    "parse_timestamp",
    "percent_change",
    "percent_of",
    "rounded_percent",
    "strip_blanks",
    "whole_number_text",
    "without_total",
    "word_tokens",
]
