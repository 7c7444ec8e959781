"""Contact exposure: was a person called on 1 to 14 days before a prescribing day?"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.schemas import CALL_LOOKBACK_DAYS


def script_and_call_marks(scripts: DataFrame, calls: DataFrame, *keys: str) -> DataFrame:
    """Both feeds as one: (keys, trx, scripts, calls), a row counting as a script or as a call."""
    return scripts.select(
        *keys, F.col("trx").cast("bigint").alias("trx"),
        F.lit(1).alias("scripts"), F.lit(0).alias("calls"),
    ).unionByName(calls.select(
        *keys, F.lit(None).cast("bigint").alias("trx"),
        F.lit(0).alias("scripts"), F.lit(1).alias("calls"),
    ))


def add_up(marks: DataFrame, *keys: str) -> DataFrame:
    return marks.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("trx", "scripts", "calls")])


def person_days(scripts: DataFrame, calls: DataFrame) -> DataFrame:
    """One row per person and day over both feeds: (hcp_id, day, trx, scripts, calls).

    ``scripts`` brings (hcp_id, day, trx), ``calls`` brings (hcp_id, day). Both are added up in one
    aggregation, so a person ends up with at most one row per day of the calendar.
    """
    return add_up(script_and_call_marks(scripts, calls, "hcp_id", "day"), "hcp_id", "day")


def with_prior_calls(days: DataFrame, lookback: int = CALL_LOOKBACK_DAYS) -> DataFrame:
    """Prescribing days with ``prior_calls``, the calls 1..lookback days earlier (not the same day)."""
    window = (
        Window.partitionBy("hcp_id").orderBy(F.unix_date("day")).rangeBetween(-lookback, -1)
    )
    return (
        days.withColumn("prior_calls", F.coalesce(F.sum("calls").over(window), F.lit(0)))
        .where("scripts > 0")
        .select("hcp_id", "day", "trx", "prior_calls")
    )


def prior_calls_by_range_join(scripts: DataFrame, calls: DataFrame,
                              lookback: int = CALL_LOOKBACK_DAYS) -> DataFrame:
    """The same result as a range join, for calls that carry attributes a window cannot add up.

    Days fall into blocks of ``lookback`` days. A call can only be seen from the block of the next
    day or the one after it, so joining on (person, block) meets at most 2 * lookback call days per
    prescribing day instead of all days of the person.
    """
    def block(day):
        return F.floor(F.unix_date(day) / lookback)

    rx = scripts.groupBy("hcp_id", "day").agg(F.sum("trx").cast("bigint").alias("trx"))
    contacts = (
        calls.groupBy("hcp_id", F.col("day").alias("call_day")).agg(F.count(F.lit(1)).alias("calls"))
        .withColumn("block", F.explode(F.array_distinct(F.array(
            block(F.date_add("call_day", 1)), block(F.date_add("call_day", lookback))))))
    )
    return (
        rx.withColumn("block", block(F.col("day"))).join(
            contacts.withColumnsRenamed({"hcp_id": "c_hcp", "block": "c_block"}),
            (F.col("hcp_id") == F.col("c_hcp")) & (F.col("block") == F.col("c_block"))
            & F.col("call_day").between(F.date_sub("day", lookback), F.date_sub("day", 1)),
            "left",
        )
        .groupBy("hcp_id", "block", "day", "trx")  # with the block, the join's shuffle serves
        .agg(F.coalesce(F.sum("calls"), F.lit(0)).alias("prior_calls"))
        .drop("block")
    )
