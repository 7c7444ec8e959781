"""Fact loads: type, resolve, split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.dates import year_month
from starloom.operators.coerce import REASON, TYPED, annotate_types, typed_values
from starloom.operators.resolve import annotate_keys
from starloom.schemas import FactFeed
from starloom.sources.feeds import MALFORMED
from starloom.sources.tables import LOADED, NO_MONTH, OUTCOME, REJECTED

NATURAL_KEYS = ("hcp_id", "product_code", "day")


def annotate_fact(staged: DataFrame, feed: FactFeed, stretches: DataFrame, products: DataFrame,
                  dim_date: DataFrame) -> DataFrame:
    """Every staged line once: raw text, typed values, keys, and the first reason to reject it.

    Keys are resolved first, so that only text moves to the dimensions and is typed where it ends up.
    """
    keyed = annotate_keys(staged, stretches, products, dim_date, feed.date_col)
    typed = annotate_types(keyed.withColumnRenamed(REASON, "_key_reason"), **feed.rules())
    reasons = [F.col(REASON), F.col("_key_reason")]
    if MALFORMED in staged.columns:
        reasons.insert(0, F.when(F.col(MALFORMED).isNotNull(), F.lit("malformed line")))
    keys = [c for c in keyed.columns if c not in (*staged.columns, REASON)]
    return typed.select(*staged.columns, TYPED, *keys, F.coalesce(*reasons).alias(REASON))


def split_ready(annotated: DataFrame, feed: FactFeed) -> DataFrame:
    """Typed fact columns for loaded rows and raw text for rejected ones, told apart by ``outcome``.

    The unused side of each row is null, which Parquet stores for next to nothing. So one pass
    feeds both tables and every line lands in exactly one of them.
    """
    loaded = F.col(REASON).isNull()
    typed = {f.name for f in annotated.schema[TYPED].dataType.fields}
    values = [
        F.when(loaded, F.col(f"{TYPED}.{m}") if m in typed else F.col(m)).alias(m)
        for m in feed.measures
    ]
    keys = [F.when(loaded, F.col(k)).alias(k)
            for k in ("date_key", "hcp_key", "product_key", "territory_key")]
    raw = [F.when(~loaded, F.col(c)).alias(f"raw_{c}") for c in raw_columns(annotated, feed)]
    return annotated.select(
        *keys, *values, *raw, REASON,
        F.when(loaded, F.lit(LOADED)).otherwise(F.lit(REJECTED)).alias(OUTCOME),
        F.when(loaded, year_month(F.col(f"{TYPED}.{feed.date_col}"))).otherwise(F.lit(NO_MONTH))
        .alias("year_month"),
    )


def text_measures(lines: DataFrame, feed: FactFeed, measures: Sequence[str]) -> DataFrame:
    """Natural keys and ``measures`` of each line, typed from its text; untypable ones count as 0."""
    typed = typed_values(lines.select(*feed.columns), feed.numeric, feed.integer, feed.dates)
    return typed.select("hcp_id", "product_code", F.col(feed.date_col).alias("day"),
                        *[F.coalesce(m, F.lit(0)).alias(m) for m in measures])


def raw_columns(df: DataFrame, feed: FactFeed) -> list[str]:
    return [*feed.columns, *([MALFORMED] if MALFORMED in df.columns else [])]


def reconciliation(feed_name: str, staged: DataFrame, annotated: DataFrame) -> DataFrame:
    """One row: lines staged, loaded and rejected, and whether they add up."""
    seen = annotated.agg(
        F.count_if(F.col(REASON).isNull()).alias("loaded"),
        F.count_if(F.col(REASON).isNotNull()).alias("rejected"),
    )
    whole = staged.agg(F.count(F.lit(1)).alias("staged"))
    both = whole.select("staged", F.lit(None).cast("bigint").alias("loaded"),
                        F.lit(None).cast("bigint").alias("rejected")).unionByName(
        seen.select(F.lit(None).cast("bigint").alias("staged"), "loaded", "rejected"))
    return both.agg(*[F.max(c).alias(c) for c in both.columns]).select(
        F.lit(feed_name).alias("feed"), "staged", "loaded", "rejected",
        (F.col("staged") == F.col("loaded") + F.col("rejected")).alias("reconciled"))
