"""Exact medians and exact distinct counts without a buffer that grows with a group.

A median is found by selection: the values are counted per range, the range with the middle row is
counted in finer ranges, and so on until a range is one value. A group has at most 2 ** DIGITS
counts at a time, however many values it holds. Distinct ids are counted by bitmaps over dense
numbers, which can be merged: one pass gives the bitmaps of the finest groups, and the groups of any
grouping set are unions of those.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DIGITS = 11


def _equal(a: DataFrame, b: DataFrame, columns: Sequence[str]) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & a[c].eqNullSafe(b[f"{c}_"])
    return out


def _renamed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed({c: f"{c}_" for c in columns})


def medians(df: DataFrame, group_by: Sequence[str], value: str, weight: str,
            bits: int = 33) -> DataFrame:
    """(group, low, high): the lower and the upper middle value of each group.

    ``value`` is a whole number of at most ``bits`` bits, taken ``weight`` times; rows without a
    value are left out, a null group is a group. The median is the mean of the two.
    """
    group = list(group_by)
    rows = df.where(F.col(value).isNotNull()).select(
        *group, F.col(value).cast("long").alias("v"), F.col(weight).cast("long").alias("w"))
    middle = F.array(F.struct(F.lit("low").alias("which"), F.expr("(n + 1) div 2").alias("rank")),
                     F.struct(F.lit("high").alias("which"), F.expr("n div 2 + 1").alias("rank")))
    wanted = rows.groupBy(*group).agg(F.sum("w").alias("n")).select(
        *group, F.inline(middle), F.lit(0).cast("long").alias("prefix"))
    shift = above = bits + (-bits % DIGITS)
    while shift:
        above, shift = shift, shift - DIGITS
        here = _renamed(wanted, group)
        match = _equal(rows, here, group)
        if above < bits:
            match = match & (F.shiftright("v", above) == here["prefix"])
        counts = rows.join(here, match).groupBy(
            *group, "which", "rank", F.shiftright("v", shift).alias("range")).agg(
            F.sum("w").alias("n"))
        so_far = F.sum("n").over(Window.partitionBy(*group, "which").orderBy("range").rowsBetween(
            Window.unboundedPreceding, Window.currentRow))
        wanted = counts.withColumn("end", so_far).where(
            F.col("rank").between(F.col("end") - F.col("n") + 1, F.col("end"))).select(
            *group, "which", (F.col("rank") - F.col("end") + F.col("n")).alias("rank"),
            F.col("range").alias("prefix"))
    found = [F.max(F.when(F.col("which") == w, F.col("prefix"))).alias(w) for w in ("low", "high")]
    return wanted.groupBy(*group).agg(*found)


def distinct_ids(df: DataFrame, number: str, sets: Sequence[Sequence[str]]) -> DataFrame:
    """(columns of all sets, set_id, ids): distinct values of ``number`` in each group of each set.

    ``set_id`` is the place of the set in ``sets``; columns that a set does not group by are null.
    Numbers should be dense, since a bitmap covers 32,768 of them.
    """
    columns = list(dict.fromkeys(c for s in sets for c in s))
    finest = df.where(F.col(number).isNotNull()).groupBy(
        *columns, F.bitmap_bucket_number(number).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits"))
    marked = finest.select("bucket", "bits", F.inline(F.array(*[
        F.struct(F.lit(k).alias("set_id"), *[
            (F.col(c) if c in s else F.lit(None).cast(df.schema[c].dataType)).alias(c)
            for c in columns]) for k, s in enumerate(sets)])))
    merged = marked.groupBy("set_id", *columns, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.groupBy("set_id", *columns).agg(F.sum(F.bitmap_count("bits")).alias("ids"))
