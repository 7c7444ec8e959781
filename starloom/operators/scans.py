"""Previous values, running sums and changes over groups of any size.

A window over (group, order) takes a whole group into one task, which does not hold when one person,
brand or territory carries a third of the rows. Here the rows are range-partitioned on (group,
order), so a large group is spread over neighbouring partitions, and each partition scans its own
stretch of the group. What a stretch starts from, the sums of the stretches before it and the last
row of the one before, is carried over a table of borders: at most the first and the last group of a
partition go on in another one, so it has two rows per partition however many rows there are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.session import pin

PART, GROUP = "_part", "_group"


def _borders(placed: DataFrame, order: Column, sums: Mapping[str, str],
             last: Column) -> DataFrame:
    """(part, group) of every stretch of a group that lies in several partitions, with what the
    stretches before it hand on."""
    ends = placed.groupBy(PART).agg(F.min(GROUP).alias("low"), F.max(GROUP).alias("high"))
    edge = ends.select(PART, F.explode(F.array("low", "high")).alias(GROUP)).distinct()
    split = edge.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(GROUP))).where(
        "_n > 1").drop("_n")
    mine = (placed[PART] == split[PART]) & placed[GROUP].eqNullSafe(split[GROUP])
    # Two rows per partition at most.
    stretches = placed.join(F.broadcast(split), mine, "left_semi").groupBy(PART, GROUP).agg(
        F.max(F.struct(order.alias("at"), last.alias("row"))).alias("_last"),
        *[F.sum(c).alias(f"_sum_{name}") for name, c in sums.items()])
    along = Window.partitionBy(GROUP).orderBy(PART)
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    return stretches.select(
        F.col(PART).alias("_border_part"), F.col(GROUP).alias("_border_group"),
        F.lag("_last.row").over(along).alias("_carried"),
        *[F.sum(f"_sum_{name}").over(before).alias(f"_sum_{name}") for name in sums])


def with_scans(df: DataFrame, group_by: Sequence[str], order_by: Sequence[str],
               previous: Mapping[str, str] | None = None, sums: Mapping[str, str] | None = None,
               changes: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """``df`` with values carried along the rows of each group, in the order of ``order_by``.

    ``previous`` maps new columns to the column whose value in the row before they hold, ``sums`` to
    the column they add up, this row included, ``changes`` to the columns of which at least one
    differs from the row before (true in the first row). The order must be unique within a group;
    null groups are a group, null values are equal to each other and add nothing.
    """
    previous, sums, changes = dict(previous or {}), dict(sums or {}), dict(changes or {})
    watched = sorted({*previous.values(), *(c for cs in changes.values() for c in cs)})
    order = F.struct(*order_by)
    last = F.struct(F.lit(True).alias("_there"), *watched)
    # Written down: partition numbers must not change when lost tasks are run again.
    placed = pin(df.repartitionByRange(*group_by, *order_by).withColumn(
        PART, F.spark_partition_id())).withColumn(GROUP, F.struct(*group_by))
    carried = F.broadcast(_borders(placed, order, sums, last))
    stretch = Window.partitionBy(PART, *group_by).orderBy(*order_by)
    so_far = stretch.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    scanned = placed.withColumns({
        "_before": F.lag(last).over(stretch),
        **{f"_so_far_{name}": F.sum(c).over(so_far) for name, c in sums.items()}})
    joined = scanned.join(
        carried, (F.col(PART) == F.col("_border_part"))
        & F.col(GROUP).eqNullSafe(F.col("_border_group")), "left").withColumn(
        "_before", F.coalesce("_before", "_carried"))

    def added(name: str) -> Column:
        here, earlier = F.col(f"_so_far_{name}"), F.col(f"_sum_{name}")
        return F.coalesce(here + earlier, here, earlier)

    def changed(columns: Sequence[str]) -> Column:
        now, was = F.struct(*columns), F.struct(*[F.col(f"_before.{c}") for c in columns])
        return F.col("_before").isNull() | ~now.eqNullSafe(was)
    return joined.select(
        *df.columns,
        *[F.col(f"_before.{c}").alias(name) for name, c in previous.items()],
        *[added(name).alias(name) for name in sums],
        *[changed(columns).alias(name) for name, columns in changes.items()])
