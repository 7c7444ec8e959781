"""Calendar attributes of a day."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(day: Column) -> Column:
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def year_month(day: Column) -> Column:
    return F.substring(day.cast("string"), 1, 7)  # much cheaper than a format pattern


def calendar_columns(day: Column) -> list[Column]:
    return [
        date_key(day).alias("date_key"),
        day.alias("full_date"),
        F.year(day).cast("smallint").alias("year"),
        F.quarter(day).cast("smallint").alias("quarter"),
        F.month(day).cast("smallint").alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        year_month(day).alias("year_month"),
    ]
