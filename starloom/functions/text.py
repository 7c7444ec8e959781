"""Strict text-to-value expressions. Nothing here raises: what does not parse becomes null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
LOOSE_DATE = r"^\d{4}-\d{1,2}-(\d{1,2}| [1-9])\z"
STRICT_DATE = r"^\d{4}-\d{2}-\d{2}\z"
FIRST_DAY = "0001-01-01"


def is_blank(text: Column) -> Column:
    return text.isNull() | text.rlike(r"^\s*$")


def to_number(text: Column) -> Column:
    """Double or null; infinite when it overflows. A plain cast would also take '1d' and 'NaN'."""
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def to_whole_number(text: Column) -> Column:
    """As ``to_number``, sparing the pattern where the text already reads as an integer."""
    return F.coalesce(text.try_cast("bigint").cast("double"), to_number(text))


def _to_date(text: Column, pattern: str) -> Column:
    matches = text.rlike(pattern) & ~text.startswith("0000")
    return F.when(matches, F.translate(text, " ", "").try_cast("date"))


def to_day(text: Column) -> Column:
    """year-month-day, month and day of one or two digits, a one-digit day also after a blank.

    A plain cast would also take '2024' and '2024-01-05T10:00'.
    """
    return _to_date(text, LOOSE_DATE)


def to_padded_day(text: Column) -> Column:
    """Zero-padded year-month-day only. The calendar's bounds come from these."""
    return _to_date(text, STRICT_DATE)
