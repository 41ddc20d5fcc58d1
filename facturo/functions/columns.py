"""Column-level building blocks (multiply, parse, prefix test, ratios, text)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, TimestampNTZType

from facturo.schema import PRICE_DECIMAL, QUANTITY_DECIMAL

# The cancellation prefix of an invoice number, the Unicode
# blanks stripped from a text's ends, and the blanks that separate words.
CANCEL_PREFIX = "C"
BLANK = r"[\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
BLANK_EDGES = rf"\A{BLANK}+|{BLANK}+\z"
BLANKS = r"\s+"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def line_total(quantity: str | Column, price: str | Column) -> Column:
    """Quantity x price in exact decimal arithmetic (decimal(32,8)).

    Null if a factor is null, NaN or out of range, or if a price that is not
    zero is too small to be told from it; ``without_total`` finds such lines,
    and the valid-sales filter leaves them out.
    """
    exact = _col(price).try_cast(PRICE_DECIMAL)
    return F.when((_col(price) == 0) | (exact != 0), _col(quantity).try_cast(QUANTITY_DECIMAL) * exact)


def without_total(quantity: str | Column, price: str | Column) -> Column:
    """True for a line that has a quantity and a price, but whose total can't be held exactly."""
    return _col(quantity).isNotNull() & _col(price).isNotNull() & line_total(quantity, price).isNull()


def as_money_double(c: str | Column) -> Column:
    """Exact decimal money to double, once, at the end of a computation."""
    return _col(c).cast(DoubleType())


def parse_timestamp(c: str | Column) -> Column:
    """Text to a time-zone-free timestamp; unparsable text gives null."""
    return _col(c).try_cast(TimestampNTZType())


def is_cancelled(invoice: str | Column) -> Column:
    """True when the invoice number starts with the cancellation prefix."""
    return _col(invoice).startswith(CANCEL_PREFIX)


def count_true(c: str | Column) -> Column:
    """Number of rows where a boolean column is true (nulls not counted)."""
    return F.count_if(_col(c))


def null_safe_ratio(num: str | Column, den: str | Column) -> Column:
    """num / den as double; null when den is zero or null."""
    return F.try_divide(_col(num).cast(DoubleType()), _col(den).cast(DoubleType()))


def percent_of(num: str | Column, den: str | Column) -> Column:
    """num / den * 100 as double; null when den is zero."""
    return null_safe_ratio(num, den) * F.lit(100.0)


def percent_change(current: str | Column, previous: str | Column) -> Column:
    """(current / previous - 1) * 100; null without a previous value or for zero."""
    return (null_safe_ratio(current, previous) - F.lit(1.0)) * F.lit(100.0)


def rounded_percent(part: str | Column, whole: str | Column) -> Column:
    """part / whole * 100 rounded half-up to 2 places, in exact integer maths.

    ``floor((2 * part * 10000 + whole) / (2 * whole)) / 100`` avoids double
    rounding at .5 boundaries, so every engine gives the same double.
    """
    p = _col(part).cast("long")
    w = _col(whole).cast("long")
    hundredths = F.try_divide(p * F.lit(20000) + w, w * F.lit(2))
    return F.when(w > 0, F.floor(hundredths).cast(DoubleType()) / F.lit(100.0))


def strip_blanks(c: str | Column) -> Column:
    """Remove leading and trailing whitespace of any kind (not just spaces)."""
    return F.regexp_replace(_col(c), BLANK_EDGES, "")


def word_tokens(c: str | Column) -> Column:
    """Array of the words of a text, without empty ones at its ends."""
    return F.filter(F.split(_col(c), BLANKS), lambda word: word != "")


def whole_number_text(c: str | Column) -> Column:
    """Numeric value to a whole number through double ("13085.0" -> 13085); null if NaN or out of range."""
    return _col(c).try_cast(DoubleType()).try_cast("long")


def month_end(ts: str | Column) -> Column:
    """Label of the calendar month of a timestamp: its last day."""
    return F.last_day(_col(ts))
