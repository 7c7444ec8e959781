"""Natural keys to surrogate keys, as of the day of the fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.functions import text
from starloom.operators.coerce import REASON
from starloom.schemas import OPEN_END
from starloom.session import pin



def unique_lookup(dim: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value) of a dimension after checking that no key is repeated."""
    repeated = dim.groupBy(key).count().where("count > 1").first()
    if repeated is not None:
        raise ValueError(f"{key} is not unique: {repeated[key]}")
    return dim.select(key, value)


def version_marks(dim: DataFrame, business_key: str, *ids: str) -> DataFrame:
    """Per person and day: versions that start, versions that ended the day before, id deltas.

    Added up here, so a person has one mark per day however many versions the input repeats.
    """
    def mark(day: Column, starts: int, ends: int, sign: int) -> Column:
        return F.struct(
            day.alias("mark_day"), F.lit(starts).alias("starts"), F.lit(ends).alias("ends"),
            *[(F.col(c).cast("bigint") * sign).alias(c) for c in ids])

    valid = F.col("valid_from") <= F.col("valid_to")
    marks = F.array(
        mark(F.lit(text.FIRST_DAY).cast("date"), 0, 0, 0),
        F.when(valid, mark(F.col("valid_from"), 1, 0, 1)),
        F.when(valid & (F.col("valid_to") < F.lit(OPEN_END)),
               mark(F.date_add("valid_to", 1), 0, 1, -1)),
    )
    return (
        dim.select(business_key, F.inline(marks))
        .where(F.col("mark_day").isNotNull())
        .groupBy(business_key, "mark_day")
        .agg(*[F.sum(c).alias(c) for c in ("starts", "ends", *ids)])
    )


def version_segments(dim: DataFrame, business_key: str = "hcp_id",
                     ids: tuple[str, ...] = ("hcp_key", "territory_key")) -> DataFrame:
    """The time line of each known person cut into gap-free, non-overlapping stretches.

    ``versions`` counts the versions covering a stretch; where it is 1, ``ids`` are that version's.
    A fact therefore meets exactly one stretch of its person and never multiplies.
    """
    person = Window.partitionBy(business_key).orderBy("mark_day")
    so_far = person.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    versions = F.sum(F.col("starts") - F.col("ends")).over(so_far)
    return (
        version_marks(dim, business_key, *ids)
        .select(
            business_key,
            F.col("mark_day").alias("seg_from"),
            F.coalesce(F.date_sub(F.lead("mark_day").over(person), 1), F.lit(OPEN_END))
            .alias("seg_to"),
            versions.alias("versions"),
            *[F.sum(c).over(so_far).alias(c) for c in ids],
        )
        .select(
            business_key, "seg_from", "seg_to", "versions",
            *[F.when(F.col("versions") == 1, F.col(c)).alias(c) for c in ids],
        )
    )


def annotate_keys(facts: DataFrame, stretches: DataFrame, products: DataFrame,
                  dim_date: DataFrame, date_col: str, day: Column | None = None) -> DataFrame:
    """Every fact once, with the four keys and ``reject_reason`` (null when all resolved).

    ``stretches`` is a pinned ``version_segments``, ``products`` a ``unique_lookup``. Joins carry no
    broadcast hint: Spark broadcasts a dimension when its measured size allows and otherwise
    shuffles on the key, where skew handling splits the facts of a hot person or product (each
    piece meets the same few dimension rows).
    """
    if day is None:
        day = F.col(date_col)
        if facts.schema[date_col].dataType.simpleString() == "string":
            day = text.to_day(day)
    days = dim_date.select(F.col("full_date").alias("_calendar_day"), "date_key")
    reason = (
        F.when(F.col("_day").isNull(), F.lit(f"missing or invalid {date_col}"))
        .when(F.col("product_key").isNull(), F.lit("unknown product_code"))
        .when(F.col("versions").isNull(), F.lit("unknown hcp_id"))
        .when(F.col("versions") > 1, F.lit("overlapping HCP versions"))
        .when(F.col("hcp_key").isNull(), F.lit("no valid HCP version"))
        .when(F.col("date_key").isNull(), F.lit("date outside dim_date"))
    )
    return (
        facts.withColumn("_day", day.cast("date"))
        .join(products, "product_code", "left")
        .join(stretches.withColumnRenamed("hcp_id", "_hcp_id"),
              (F.col("hcp_id") == F.col("_hcp_id"))
              & F.col("_day").between(F.col("seg_from"), F.col("seg_to")), "left")
        .join(days, F.col("_day") == F.col("_calendar_day"), "left")
        .withColumn(REASON, reason)
        .select(*facts.columns, "date_key", "hcp_key", "product_key", "territory_key", REASON)
    )


def resolve_surrogate_keys(facts: DataFrame, dim_hcp: DataFrame, dim_product: DataFrame,
                           dim_date: DataFrame, date_col: str = "rx_date"
                           ) -> tuple[DataFrame, DataFrame]:
    """(resolved facts with keys instead of natural keys, rejected facts with their reason)."""
    annotated = annotate_keys(
        facts, pin(version_segments(dim_hcp)),
        unique_lookup(dim_product, "product_code", "product_key"), dim_date, date_col)
    resolved = annotated.where(F.col(REASON).isNull()).drop(
        REASON, date_col, "hcp_id", "product_code")
    return resolved, annotated.where(F.col(REASON).isNotNull()).select(*facts.columns, REASON)
