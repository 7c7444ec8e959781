import math
import random

import pandas as pd
import pytest
from helpers import day, rows
from pyspark.sql import functions as F

from starloom.functions import text
from starloom.operators.coerce import REASON, annotate_types, coerce_columns, with_typed_columns


def text_frame(spark, values, column="trx_count"):
    return spark.createDataFrame([(v,) for v in values], f"{column} string")


def test_bad_number_is_rejected_with_its_text(spark):
    clean, rejects = coerce_columns(text_frame(spark, ["3", "N/A", "7"]), integer=["trx_count"])
    assert rows(clean) == [(3,), (7,)]
    assert rows(rejects) == [("N/A", "non-numeric value in trx_count")]


def test_every_row_is_clean_or_rejected(spark):
    clean, rejects = coerce_columns(text_frame(spark, ["1", "x", "3", "y"]), integer=["trx_count"])
    assert clean.count() + rejects.count() == 4


@pytest.mark.parametrize("value, reason", [
    ("3.7", "non-integer value in trx_count"),
    (None, "missing value in trx_count"),
    ("", "missing value in trx_count"),
    ("  ", "missing value in trx_count"),
    ("inf", "non-numeric value in trx_count"),
    ("-inf", "non-numeric value in trx_count"),
    ("NaN", "non-numeric value in trx_count"),
    ("1e400", "non-numeric value in trx_count"),
    ("0x10", "non-numeric value in trx_count"),
    ("1_000", "non-numeric value in trx_count"),
    ("1d", "non-numeric value in trx_count"),
    ("3f", "non-numeric value in trx_count"),
    ("True", "non-numeric value in trx_count"),
    ("2147483648", "out-of-range value in trx_count"),
    ("-1", "out-of-range value in trx_count"),
    ("-1.5", "non-integer value in trx_count"),
])
def test_rejected_counts(spark, value, reason):
    clean, rejects = coerce_columns(text_frame(spark, [value]), integer=["trx_count"])
    assert clean.isEmpty()
    assert rows(rejects) == [(value, reason)]


def test_accepted_counts(spark):
    values = ["0", "3", "42", " 3 ", "+3", "3.0", "1e3", "3.", "2147483647"]
    clean, rejects = coerce_columns(text_frame(spark, values), integer=["trx_count"])
    assert rejects.isEmpty()
    assert sorted(r[0] for r in clean.collect()) == [0, 3, 3, 3, 3, 3, 42, 1000, 2147483647]


@pytest.mark.parametrize("column, good, bad", [
    ("decile", ["1", "10"], ["0", "11"]),
    ("duration_minutes", ["0", "32767"], ["-1", "32768"]),
    ("other", ["-9223372036854775808", "9007199254740993"], ["9223372036854775808", "1e30"]),
])
def test_bounds(spark, column, good, bad):
    clean, rejects = coerce_columns(text_frame(spark, good + bad, column), integer=[column])
    assert sorted(r[0] for r in clean.collect()) == sorted(int(v) for v in good)
    assert rows(rejects) == sorted(
        [(v, f"out-of-range value in {column}") for v in bad], key=repr)


def test_money_is_rounded_half_up_from_its_text(spark):
    clean, rejects = coerce_columns(
        text_frame(spark, ["1.005", "-3", "1e3", "9999999999.99", "99999999999"], "units"),
        numeric=["units"])
    assert sorted(str(r[0]) for r in clean.collect()) == [
        "-3.00", "1.01", "1000.00", "9999999999.99"]
    assert rows(rejects) == [("99999999999", "out-of-range value in units")]


def test_dates(spark):
    good = ["2024-01-05", "2024-1-5", "2024-1- 5", "2024-02-29"]
    bad = [None, "", "2024-02-30", "2023-02-29", "2024-01", "2024", "2024-01-05T10:00",
           "2024-01-05 ", "05/01/2024", "0000-01-01"]
    clean, rejects = coerce_columns(text_frame(spark, good + bad, "rx_date"), dates=["rx_date"])
    assert rows(clean) == [(day("2024-01-05"),)] * 3 + [(day("2024-02-29"),)]
    assert rows(rejects) == sorted([(v, "unparseable date in rx_date") for v in bad], key=repr)


def test_first_faulty_column_gives_the_reason(spark):
    df = spark.createDataFrame(
        [("x", "y", "z"), ("1", "y", "z"), ("1", "2", "z"), ("1", "2", "2024-01-01")],
        "units string, trx_count string, rx_date string")
    annotated = annotate_types(df, numeric=["units"], integer=["trx_count"], dates=["rx_date"])
    assert {tuple(r) for r in annotated.select("units", "trx_count", REASON).collect()} == {
        ("x", "y", "non-numeric value in units"), ("1", "y", "non-numeric value in trx_count"),
        ("1", "2", "unparseable date in rx_date"), ("1", "2", None)}


def test_required_and_listed_values(spark):
    df = spark.createDataFrame(
        [("A", "DETAIL"), (None, "DETAIL"), ("A", "VISIT"), ("A", None)],
        "full_name string, call_type string")
    _, rejects = coerce_columns(df, required=["full_name"], allowed={"call_type": ("DETAIL",)})
    assert sorted(r[REASON] for r in rejects.collect()) == [
        "invalid call_type", "invalid call_type", "missing value in full_name"]


def test_missing_column_is_a_schema_error(spark):
    with pytest.raises(ValueError, match="Missing source columns"):
        coerce_columns(text_frame(spark, ["1"], "other"), integer=["trx_count"])


def test_fractions_have_no_typed_count(spark):
    annotated = annotate_types(text_frame(spark, ["3.7", "3"]), integer=["trx_count"])
    assert rows(with_typed_columns(annotated)) == [(3,), (None,)]


def test_a_filter_does_not_repeat_the_patterns(spark):
    clean, _ = coerce_columns(text_frame(spark, ["1"]), integer=["trx_count"])
    plan = clean._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RLIKE(trx_count") <= 2


def test_numbers_parse_as_pandas_does(spark):
    """Random text of number-like characters: the same strings are numbers, with the same value."""
    rng = random.Random(1)
    texts = sorted({"".join(rng.choice("0123456789+-.eE _xdf ,\t%") for _ in range(rng.randrange(8)))
                    for _ in range(8000)})
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    found = {r.v: r.n for r in df.select("v", text.to_whole_number(F.col("v")).alias("n")).collect()}
    for t in texts:
        expected = float(pd.to_numeric(pd.Series([t], dtype=object), errors="coerce").iloc[0])
        mine = found[t] if found[t] is not None and math.isfinite(found[t]) else math.nan
        assert mine == pytest.approx(expected, rel=1e-12, nan_ok=True), repr(t)


def test_days_parse_as_pandas_does(spark):
    rng = random.Random(2)
    pick = rng.choice
    texts = sorted({
        f"{pick(['2024', '2023', '1900', '0000', '24', '02024'])}{pick('---/')}"
        f"{pick(['1', '01', '12', '13', '0', '00', '2', '02', '001', ' 1'])}{pick('---/')}"
        f"{pick(['1', '01', '29', '30', '31', '32', '0', '9', '009', '1 ', ' 1', ' 10'])}"
        for _ in range(4000)})
    expected = pd.to_datetime(pd.Series(texts), format="%Y-%m-%d", errors="coerce")
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    found = {r.v: r.d for r in df.select("v", text.to_day(F.col("v")).alias("d")).collect()}
    assert found == {t: None if pd.isna(e) else e.date()
                     for t, e in zip(texts, expected, strict=True)}
