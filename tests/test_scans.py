"""Scans with carried borders against plain windows, a third of the rows in one group."""

import random

import pytest
from helpers import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from starloom.operators.scans import PART, with_scans


def plain(df, group):
    along = Window.partitionBy(*group).orderBy("day", "n")
    so_far = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    state = F.struct("state")
    return df.select(
        *df.columns, F.lag("trx").over(along).alias("before"),
        F.sum("trx").over(so_far).alias("to_date"),
        (F.lag(F.lit(1)).over(along).isNull()
         | ~state.eqNullSafe(F.struct(F.lag("state").over(along)))).alias("changed"))


@pytest.mark.parametrize("partitions", ["1", "13"])
def test_scans_equal_windows_with_a_hot_group(spark, partitions):
    rng = random.Random(4)
    data = []
    for n in range(6000):
        person = 0 if rng.random() < 1 / 3 else rng.choice([None, *range(1, 40)])
        data.append((person, rng.choice(["a", "b", None]), rng.randrange(50), n,
                     rng.choice([None, 1, 2, 3]), rng.choice([None, "x", "x", "y"])))
    df = spark.createDataFrame(
        data, "person int, brand string, day int, n int, trx long, state string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for group in (["person"], ["person", "brand"]):
            found = with_scans(df, group, ["day", "n"], {"before": "trx"}, {"to_date": "trx"},
                               {"changed": ["state"]})
            assert rows(found) == rows(plain(df, group))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_the_hot_group_is_spread(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(8000).select(
            F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("g"), F.col("id").alias("n"))
        parts = df.repartitionByRange("g", "n").groupBy(F.spark_partition_id().alias(PART)).count()
        assert parts.agg(F.max("count")).first()[0] < 8000 / 8
        total = with_scans(df, ["g"], ["n"], sums={"s": "n"}).where("g = 0")
        assert total.agg(F.max("s")).first()[0] == sum(range(0, 8000, 3))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_no_rows_and_first_rows(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 2, None), (2, 1, 5)], "g int, n int, v int")
    scan = dict(previous={"p": "v"}, sums={"s": "v"}, changes={"c": ["v"]})
    assert rows(with_scans(df, ["g"], ["n"], **scan)) == [
        (1, 1, None, None, None, True), (1, 2, None, None, None, False), (2, 1, 5, None, 5, True)]
    assert with_scans(df.limit(0), ["g"], ["n"], **scan).isEmpty()
