"""Row numbers, ranks and dense keys over groups of any size.

A plain ``row_number().over(Window.partitionBy(g))`` sorts each group in one task, which does not
hold when one group carries a third of the rows, or when there is no group at all (surrogate keys).
Here the rows are range-partitioned and sorted on (group, order), so a group is spread over as many
partitions as its size asks for, and written down with the id Spark gives each row: the partition
number above bit 33, the place in the partition below. These ids ascend in sort order; with the row
count of each partition they become gap-free numbers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.session import pin

ROW_BITS = 33
PLACE = "_place"


def _placed(df: DataFrame, order: Sequence[Column]) -> tuple[DataFrame, DataFrame]:
    """The rows with their place, and the number of rows before each partition."""
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = pin(ordered.withColumn(PLACE, F.monotonically_increasing_id()))
    counts = placed.groupBy(F.shiftright(PLACE, ROW_BITS).alias("_part")).agg(
        F.count(F.lit(1)).alias("_rows"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_rows").over(earlier), F.lit(0))
    return placed, counts.select("_part", before.alias("_before"))


def _number_places(df: DataFrame, place: str, offsets: DataFrame, number: str) -> DataFrame:
    """Turn places into 1, 2, 3, ... ``offsets`` has one row per partition, hence the broadcast."""
    row = F.col(place).bitwiseAND(F.lit(2**ROW_BITS - 1))
    return (
        df.withColumn("_part", F.shiftright(place, ROW_BITS))
        .join(F.broadcast(offsets), "_part")
        .withColumn(number, F.col("_before") + row + 1)
        .drop("_part", "_before", place)
    )


def with_keys(df: DataFrame, order_by: Sequence[str], key: str,
              start_after: int = 0) -> DataFrame:
    """Add ``key`` = start_after + 1, 2, 3, ... in the order of ``order_by``, which must be unique."""
    placed, offsets = _placed(df, [F.col(c) for c in order_by])
    numbered = _number_places(placed, PLACE, offsets, key)
    return numbered.select((F.col(key) + start_after).cast("bigint").alias(key), *df.columns)


def with_ranks(df: DataFrame, group_by: str, value: str, tie_break: Sequence[str]) -> DataFrame:
    """Add ``position`` (row number), ``value_rank`` (ties share it) and ``group_rows``.

    Order is ``value`` descending, then ``tie_break`` ascending; the tie break must make it unique.
    Equal values of a group share the number of their first row, which an aggregation finds however
    many rows tie. There is one such row per distinct value; the join back to the rows broadcasts it
    when small and splits a hot value otherwise.
    """
    order = [F.col(group_by), F.col(value).desc(), *[F.col(c) for c in tie_break]]
    placed, offsets = _placed(df, order)
    ties = _number_places(
        placed.groupBy(group_by, value).agg(
            F.min(PLACE).alias("_first"), F.count(F.lit(1)).alias("_rows")),
        "_first", offsets, "_first_no")
    groups = ties.groupBy(F.col(group_by).alias("_g")).agg(
        F.min("_first_no").alias("_group_first"), F.sum("_rows").alias("group_rows"))
    ties = pin(
        ties.join(groups, F.col(group_by).eqNullSafe(F.col("_g"))).select(
            "_g", F.col(value).alias("_v"), "_group_first", "group_rows",
            (F.col("_first_no") - F.col("_group_first") + 1).alias("value_rank")))
    return (
        _number_places(placed, PLACE, offsets, "_no")
        .join(ties, F.col(group_by).eqNullSafe(F.col("_g")) & F.col(value).eqNullSafe(F.col("_v")))
        .select(*df.columns, (F.col("_no") - F.col("_group_first") + 1).alias("position"),
                "value_rank", "group_rows")
    )
