"""Exact decimal arithmetic. Ratios stay decimal so that half-way values round up, not to even."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def whole(value: Column, digits: int = 20) -> Column:
    return value.cast(f"decimal({digits},0)")


def ratio(top: Column, bottom: Column, scale_by: str = "1") -> Column:
    """``scale_by * top / bottom`` over integers, multiplied first; null when ``bottom`` is 0.

    The widths keep 13 fractional digits in the quotient, so a later ``round`` is the only rounding.
    """
    return whole(top) * F.lit(scale_by).cast("decimal(5,2)") / F.nullif(
        whole(bottom), F.lit(0).cast("decimal(20,0)"))


def percent(top: Column, bottom: Column, places: int) -> Column:
    return F.round(ratio(top, bottom, "100"), places)


def ntile_of(position: Column, group_rows: Column, tiles: int) -> Column:
    """The NTILE bucket of a 1-based position: the first ``rows mod tiles`` buckets get one extra."""
    small = F.floor(group_rows / tiles)
    extra = group_rows % tiles
    in_large = extra * (small + 1)
    return F.when(
        position <= in_large, F.ceil(position / (small + 1))
    ).otherwise(
        extra + F.ceil((position - in_large) / F.greatest(small, F.lit(1)))
    ).cast("int")
