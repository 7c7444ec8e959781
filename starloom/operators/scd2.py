"""Slowly changing dimension, type 2, as one set-based fold.

Rows of a person are ordered (live row first, then by effective day) and compared with the row
before: equal tracked values change nothing, different ones open a version that ends the day
before the next one opens. Feed rows are first reduced to one per (person, day, tracked values),
which a hot person's rows go through before they meet in one task; after that a person has at
most a few rows per day.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.schemas import OPEN_END

WINDOW_COLUMNS = ("valid_from", "valid_to", "is_current")
TRACKED = ("decile", "territory_key")


def _open_end() -> Column:
    return F.lit(OPEN_END)


def _fail(message: str | Column, type_name: str) -> Column:
    return F.raise_error(message).cast(type_name)


def _first_of_day(incoming: DataFrame, key: str, effective: str, ordinal: str) -> DataFrame:
    """The first row in feed order of each person and day."""
    rest = [c for c in incoming.columns if c not in (key, effective, ordinal)]
    first = F.min(F.struct(ordinal, *rest)).alias("_row")
    return incoming.groupBy(key, effective).agg(first).select(key, effective, "_row.*")


def _blocks(incoming: DataFrame, key: str, tracked: list[str], effective: str,
            ordinal: str | None) -> DataFrame:
    untracked = [c for c in incoming.columns if c not in (key, effective, ordinal, *tracked)]
    place = F.col(ordinal) if ordinal else F.struct(*[F.col(c) for c in (*tracked, *untracked)])
    day = F.col("_effective")
    return (
        incoming.withColumn("_effective", F.col(effective).cast("date"))
        .withColumn("_place", place)
        .groupBy(key, "_effective", *tracked)
        .agg(
            F.min("_place").alias("_first"), F.max("_place").alias("_last"),
            *[F.min_by(c, "_place").alias(c) for c in untracked],
        )
        .withColumn("_effective", F.when(
            day.isNull(), _fail(f"{effective} is missing in a change of {key}", "date")).otherwise(day))
        .withColumn("_source", F.lit(1))
    )


def _changes(existing: DataFrame | None, incoming: DataFrame, key: str, tracked: Sequence[str],
             effective: str, ordinal: str | None) -> DataFrame:
    """The rows that open a version, with ``_conflict`` where the opening day is not later."""
    tracked = list(tracked)
    rows = _blocks(incoming, key, tracked, effective, ordinal)
    if existing is not None:
        live = existing.where("is_current").withColumn("_effective", _checked_start())
        live = live.drop(*WINDOW_COLUMNS).withColumn("_source", F.lit(0))
        rows = live.unionByName(rows, allowMissingColumns=True)

    person = Window.partitionBy(key).orderBy("_source", "_effective", "_last")
    values = F.struct(*[F.col(c) for c in tracked])
    before = F.lag(F.struct(values.alias("v"), "_source", "_effective", "_last")).over(person)
    # The same day switching to and fro: these values appear again after others were seen.
    to_and_fro = (
        (F.col("_before._source") == 1) & (F.col("_source") == 1)
        & (F.col("_before._effective") == F.col("_effective"))
        & (F.col("_first") < F.col("_before._last"))
    )
    opened = (
        rows.withColumn("_before", before)
        .withColumn("_to_and_fro", F.coalesce(to_and_fro, F.lit(False)))
        .where(F.col("_before").isNull() | ~values.eqNullSafe(F.col("_before.v"))
               | F.col("_to_and_fro"))
    )
    previous = F.lag("_effective").over(person)
    return (
        opened.withColumn("_next", F.lead("_effective").over(person))
        .withColumn("_conflict", F.coalesce(F.col("_effective") <= previous, F.lit(False))
                    | F.col("_to_and_fro"))
        .drop("_before", "_to_and_fro", "_first", "_last")
    )


def _checked_start() -> Column:
    inverted = F.col("valid_from") > F.col("valid_to")
    message = F.concat(F.lit("a stored version ends on "), F.col("valid_to").cast("string"),
                       F.lit(" before it starts on "), F.col("valid_from").cast("string"))
    return F.when(inverted, _fail(message, "date")).otherwise(F.col("valid_from"))


def apply_scd2(existing: DataFrame | None, incoming: DataFrame, business_key: str = "hcp_id",
               tracked: Sequence[str] = TRACKED, effective_col: str = "effective_date",
               ordinal_col: str | None = None, same_day: str = "fail") -> DataFrame:
    """The full new state of the dimension.

    ``ordinal_col`` orders rows of the same person and day (their order in the feed). A change
    that is not later than the live version fails the job that computes ``valid_from``, so
    nothing of a bad batch can be written. With ``same_day="first"`` the first row of a person and
    day settles that day and later ones change nothing; ``scd2_conflicts`` lists such days.
    """
    if same_day not in ("fail", "first") or (same_day == "first" and ordinal_col is None):
        raise ValueError("same_day is 'fail', or 'first' together with ordinal_col")
    if same_day == "first":
        incoming = _first_of_day(incoming, business_key, effective_col, ordinal_col)
    changes = _changes(existing, incoming, business_key, tracked, effective_col, ordinal_col)
    message = F.concat(F.lit(f"{business_key} "), F.col(business_key).cast("string"),
                       F.lit(" changes twice as of "), F.col("_effective").cast("string"),
                       F.lit(" or before the version it would replace"))
    versions = changes.select(
        *[c for c in changes.columns if not c.startswith("_")],
        F.when(F.col("_conflict"), _fail(message, "date")).otherwise(F.col("_effective"))
        .alias("valid_from"),
        F.coalesce(F.date_sub("_next", 1), _open_end()).alias("valid_to"),
        F.col("_next").isNull().alias("is_current"),
    )
    if existing is None:
        return versions
    closed = existing.where(~F.col("is_current")).withColumn("valid_from", _checked_start())
    return closed.unionByName(versions, allowMissingColumns=True)


def scd2_conflicts(existing: DataFrame | None, incoming: DataFrame, business_key: str = "hcp_id",
                   tracked: Sequence[str] = TRACKED, effective_col: str = "effective_date",
                   ordinal_col: str | None = None) -> DataFrame:
    """(person, day) pairs whose change is not later than the version it would replace."""
    changes = _changes(existing, incoming, business_key, tracked, effective_col, ordinal_col)
    return (
        changes.where("_conflict")
        .select(business_key, F.col("_effective").alias(effective_col)).distinct()
    )
