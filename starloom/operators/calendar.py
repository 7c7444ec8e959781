"""The calendar dimension."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.dates import calendar_columns


def _days(bounds: DataFrame, first: Column, last: Column) -> DataFrame:
    days = bounds.select(F.explode(F.sequence(first, last)).alias("day"))
    return days.select(*calendar_columns(F.col("day")))


def build_dim_date(spark: SparkSession, start: dt.date | str, end: dt.date | str) -> DataFrame:
    """One row per day, both ends included. At most 3.7 million rows: years 1 to 9999."""
    day = lambda d: F.lit(str(d)).cast("date")
    return _days(spark.range(1), day(start), day(end))


def day_bounds(*days: DataFrame) -> DataFrame:
    """First and last day over one-column frames of days (nulls are skipped)."""
    both = days[0].toDF("day")
    for more in days[1:]:
        both = both.unionByName(more.toDF("day"))
    return both.agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"))


def calendar_over(bounds: DataFrame) -> DataFrame:
    """Calendar between the bounds of ``day_bounds``, without bringing them to the driver."""
    return _days(bounds, F.col("first_day"), F.col("last_day"))
