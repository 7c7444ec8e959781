"""Dimension loads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators.calendar import day_bounds
from starloom.operators.coerce import REASON, TYPED, annotate_types
from starloom.operators.positions import with_keys
from starloom.operators.resolve import unique_lookup
from starloom.operators.scd2 import apply_scd2
from starloom.functions import text
from starloom.schemas import CALL_FEED, HCP_FEED, PRODUCT_SCHEMA, PRODUCTS, REGIONS, RX_FEED


def dim_product(spark: SparkSession) -> DataFrame:
    """The fixed product list, keyed in list order."""
    rows = [(key, *product) for key, product in enumerate(PRODUCTS, start=1)]
    schema = "product_key bigint, " + ", ".join(
        f"{f.name} {f.dataType.simpleString()}" for f in PRODUCT_SCHEMA.fields)
    return spark.createDataFrame(rows, schema)


def territory_columns(key: Column, code: Column) -> list[Column]:
    """Name, region and country of a territory from its 1-based key and its code."""
    regions = F.array(*[F.lit(r) for r in REGIONS])
    return [
        key.alias("territory_key"),
        code.alias("territory_code"),
        F.concat(F.lit("Territory "), F.substring(code, 3, 1000)).alias("territory_name"),
        F.element_at(regions, ((key - 1) % len(REGIONS) + 1).cast("int")).alias("region"),
        F.lit("India").alias("country"),
    ]


def dim_territory(staged_hcp: DataFrame) -> DataFrame:
    """One territory per code seen in the prescriber feed, rejected rows included."""
    codes = staged_hcp.where(F.col("territory_code").isNotNull()).select("territory_code")
    keyed = with_keys(codes.distinct(), ["territory_code"], "territory_key")
    return keyed.select(*territory_columns(F.col("territory_key"), F.col("territory_code")))


def calendar_bounds(staged_rx: DataFrame, staged_calls: DataFrame) -> tuple:
    """First and last valid fact day over both feeds."""
    first, last = day_bounds(
        staged_rx.select(text.to_padded_day(F.col(RX_FEED.date_col))),
        staged_calls.select(text.to_padded_day(F.col(CALL_FEED.date_col))),
    ).first()
    if first is None:
        raise ValueError(f"neither {RX_FEED.date_col} nor {CALL_FEED.date_col} holds a valid day")
    return first, last


def annotate_hcp(staged_hcp: DataFrame, territories: DataFrame) -> DataFrame:
    """Typed prescriber rows with ``territory_key`` and ``reject_reason``."""
    places = unique_lookup(territories, "territory_code", "territory_key")
    annotated = annotate_types(staged_hcp, **HCP_FEED.rules())
    no_place = F.when(F.col("territory_key").isNull(), F.lit("unknown territory_code"))
    return annotated.join(places, "territory_code", "left").withColumn(
        REASON, F.coalesce(REASON, no_place))


def hcp_versions(annotated: DataFrame, existing: DataFrame | None = None,
                 ordinal_col: str | None = None, same_day: str = "fail") -> DataFrame:
    """Version history of the clean rows, without surrogate keys."""
    rows = annotated.where(F.col(REASON).isNull()).select(
        "hcp_id", "full_name", "specialty", F.col(f"{TYPED}.decile").alias("decile"),
        "territory_key", F.col(f"{TYPED}.effective_date").alias("effective_date"),
        *([ordinal_col] if ordinal_col else []),
    )
    return apply_scd2(existing, rows, ordinal_col=ordinal_col, same_day=same_day)


def key_new_versions(versions: DataFrame, highest: int = 0) -> DataFrame:
    """Number versions in (person, start) order after the highest key in use."""
    return with_keys(versions, ["hcp_id", "valid_from"], "hcp_key", start_after=highest)


def extend_dim_hcp(existing: DataFrame, annotated: DataFrame,
                   ordinal_col: str | None = None) -> DataFrame:
    """The dimension after another batch: versions keep their keys, new ones are numbered on."""
    versions = hcp_versions(annotated, existing, ordinal_col)
    highest = existing.agg(F.max("hcp_key")).first()[0] or 0
    opened = versions.where(F.col("hcp_key").isNull()).drop("hcp_key")
    return versions.where(F.col("hcp_key").isNotNull()).unionByName(
        key_new_versions(opened, highest))
