"""Typing of all-text rows, with a reason for each row that does not type."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions import text
from starloom.schemas import ANY_LONG, COLUMN_TYPES, INTEGER_BOUNDS

REASON = "reject_reason"
TYPED = "typed"
INFINITY = float("inf")


def _in_step(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add columns in a projection of their own, so that later steps read them computed."""
    return df.select("*", *[value.alias(name) for name, value in columns.items()])


def _value(name: str, whole: bool) -> Column:
    """Typed value of a number that parsed. Text first: a double blurs integers above 2^53."""
    source, number = F.col(name), F.col(f"_number_{name}")
    target = COLUMN_TYPES.get(name, "bigint" if whole else "double")
    if not whole:
        return F.when(F.abs(number) < INFINITY, source.try_cast(target))
    return F.when(number % 1 == 0, F.coalesce(source.try_cast(target), number.try_cast(target)))


def _number_reason(name: str, whole: bool) -> Column:
    number, value = F.col(f"_number_{name}"), F.col(f"_value_{name}")
    reason = (
        F.when(number.isNull() & text.is_blank(F.col(name)), F.lit(f"missing value in {name}"))
        .when(number.isNull() | (F.abs(number) == INFINITY),
              F.lit(f"non-numeric value in {name}"))
    )
    if whole:
        low, high = INTEGER_BOUNDS.get(name, ANY_LONG)
        reason = reason.when(number % 1 != 0, F.lit(f"non-integer value in {name}")).when(
            (number < float(low)) | (number >= float(high + 1)),
            F.lit(f"out-of-range value in {name}"))
    return reason.when(value.isNull(), F.lit(f"out-of-range value in {name}"))


def _numbers(numeric: Sequence[str], integer: Sequence[str]) -> dict[str, bool]:
    """Columns of numbers, and whether they are whole."""
    return {c: False for c in numeric} | {c: True for c in integer}


def _with_values(df: DataFrame, numbers: Mapping[str, bool], dates: Sequence[str]) -> DataFrame:
    steps = _in_step(df, {
        **{f"_number_{c}": text.to_whole_number(F.col(c)) if whole else text.to_number(F.col(c))
           for c, whole in numbers.items()},
        **{f"_value_{c}": text.to_day(F.col(c)) for c in dates},
    })
    return _in_step(steps, {f"_value_{c}": _value(c, whole) for c, whole in numbers.items()})


def typed_values(df: DataFrame, numeric: Sequence[str] = (), integer: Sequence[str] = (),
                 dates: Sequence[str] = ()) -> DataFrame:
    """``df`` with typed columns in place of text, null where a text does not type.

    The values are those of ``annotate_types`` without its verdict, so columns that are not used
    further on are not typed at all.
    """
    numbers = _numbers(numeric, integer)
    typed = {*numbers, *dates}
    return _with_values(df, numbers, dates).select(*[
        F.col(f"_value_{c}").alias(c) if c in typed else F.col(c) for c in df.columns])


def annotate_types(
    df: DataFrame,
    numeric: Sequence[str] = (),
    integer: Sequence[str] = (),
    dates: Sequence[str] = (),
    required: Sequence[str] = (),
    allowed: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """All input columns as they came, plus ``typed`` (struct) and ``reject_reason``.

    Columns are judged in the order numeric, integer, dates, required, allowed; the first column
    at fault gives the reason. A row is clean when its reason is null.
    """
    allowed = dict(allowed or {})
    missing = sorted({*numeric, *integer, *dates, *required, *allowed} - set(df.columns))
    if missing:
        raise ValueError(f"Missing source columns: {missing}")

    numbers = _numbers(numeric, integer)
    steps = _with_values(df, numbers, dates)
    reasons = [_number_reason(c, whole) for c, whole in numbers.items()]
    reasons += [F.when(F.col(f"_value_{c}").isNull(), F.lit(f"unparseable date in {c}"))
                for c in dates]
    reasons += [F.when(text.is_blank(F.col(c)), F.lit(f"missing value in {c}")) for c in required]
    reasons += [F.when(F.col(c).isNull() | ~F.col(c).isin(*values), F.lit(f"invalid {c}"))
                for c, values in allowed.items()]
    typed = [F.col(f"_value_{c}").alias(c) for c in (*numbers, *dates)]
    verdict = F.struct(
        F.struct(*typed).alias(TYPED),
        (F.coalesce(*reasons) if reasons else F.lit(None).cast("string")).alias(REASON),
    )
    # Emitted by a generator because a filter on a plain column would be rewritten into the text
    # expressions behind it and pushed down, evaluating every pattern again several times.
    return steps.select(*df.columns, F.inline(F.array(verdict)))


def with_typed_columns(annotated: DataFrame) -> DataFrame:
    """Replace the raw text by the typed values."""
    typed = {f.name for f in annotated.schema[TYPED].dataType.fields}
    return annotated.select(*[
        F.col(f"{TYPED}.{c}").alias(c) if c in typed else F.col(c)
        for c in annotated.columns if c not in (TYPED, REASON)
    ])


def coerce_columns(df: DataFrame, numeric: Sequence[str] = (), integer: Sequence[str] = (),
                   dates: Sequence[str] = (), **more) -> tuple[DataFrame, DataFrame]:
    """(clean rows with typed values, rejected rows with their raw text and ``reject_reason``)."""
    annotated = annotate_types(df, numeric, integer, dates, **more)
    clean = with_typed_columns(annotated.where(F.col(REASON).isNull()))
    return clean, annotated.where(F.col(REASON).isNotNull()).drop(TYPED)

