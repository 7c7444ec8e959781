import pytest
from helpers import day, rows

from starloom.operators.calendar import build_dim_date, calendar_over, day_bounds
from starloom.plans.dimensions import calendar_bounds


def test_one_row_per_day_both_ends_included(spark):
    january = build_dim_date(spark, "2024-01-01", "2024-01-31").collect()
    assert [r.date_key for r in january] == list(range(20240101, 20240132))
    assert {r.year_month for r in january} == {"2024-01"}
    assert january[0].month_name == "January" and january[0].quarter == 1
    assert (january[0].year, january[0].month, january[0].full_date) == (2024, 1, day("2024-01-01"))


def test_leap_day(spark):
    keys = [r.date_key for r in build_dim_date(spark, "2024-02-27", "2024-03-02").collect()]
    assert 20240229 in keys and len(keys) == 5


def test_calendar_over_bounds(spark):
    a = spark.createDataFrame([(day("2024-01-02"),), (None,)], "d date")
    b = spark.createDataFrame([(day("2024-01-05"),)], "d date")
    assert calendar_over(day_bounds(a, b)).count() == 4


def test_invalid_day_does_not_stop_the_bounds(spark):
    rx = spark.createDataFrame([("2024-02-30",), ("2024-03-01",), ("2024-1-1",)], "rx_date string")
    calls = spark.createDataFrame([("2024-02-01",), (None,)], "call_date string")
    assert calendar_bounds(rx, calls) == (day("2024-02-01"), day("2024-03-01"))


def test_no_valid_day_is_an_error(spark):
    rx = spark.createDataFrame([("x",)], "rx_date string")
    with pytest.raises(ValueError, match="holds a valid day"):
        calendar_bounds(rx, rx.toDF("call_date"))


def test_last_day_of_time(spark):
    assert rows(build_dim_date(spark, "9999-12-30", "9999-12-31"), "date_key") == [
        (99991230,), (99991231,)]
