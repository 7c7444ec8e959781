import random

import pytest
from helpers import rows

from starloom.functions.numbers import ntile_of
from starloom.operators.positions import with_keys, with_ranks
from pyspark.sql import functions as F


@pytest.mark.parametrize("sliced", [True, False])
def test_keys_follow_the_order_and_have_no_gaps(spark, sliced):
    values = list(range(1000))
    random.Random(1).shuffle(values)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", str(not sliced).lower())
    try:
        keyed = with_keys(spark.createDataFrame([(v,) for v in values], "v int"), ["v"], "k", 50)
        assert rows(keyed, "v", "k") == sorted([(v, v + 51) for v in range(1000)], key=repr)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_no_rows_no_keys(spark):
    assert with_keys(spark.createDataFrame([], "v int"), ["v"], "k").isEmpty()


@pytest.mark.parametrize("distinct", [1, 3, 40, 100000])
@pytest.mark.parametrize("sliced", [True, False])
def test_ranks_match_plain_windows(spark, distinct, sliced):
    """Also with ties that fill several slices and one group holding most rows."""
    rng = random.Random(distinct)
    data = [(rng.choice("aaaaab"), rng.randrange(distinct), i) for i in range(2000)]
    df = spark.createDataFrame(data, "g string, v int, id int")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", str(not sliced).lower())
    try:
        ranked = with_ranks(df, "g", "v", ["id"]).withColumn(
            "tile", ntile_of(F.col("position"), F.col("group_rows"), 10))
        df.createOrReplaceTempView("ranked_input")
        plain = spark.sql("""
            select g, v, id, row_number() over w, rank() over (partition by g order by v desc),
                   count(*) over (partition by g), ntile(10) over w
            from ranked_input window w as (partition by g order by v desc, id)""")
        assert rows(ranked) == rows(plain)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("n", [1, 3, 9, 10, 11, 25])
def test_ntile_sizes(spark, n):
    df = spark.range(1, n + 1).withColumnRenamed("id", "p")
    df.createOrReplaceTempView("ntile_input")
    mine = df.select("p", ntile_of(F.col("p"), F.lit(n), 10))
    assert rows(mine) == rows(spark.sql("select p, ntile(10) over (order by p) from ntile_input"))


def test_null_groups_and_values_keep_their_rows(spark):
    data = [("a", 1, 1), ("a", None, 2), ("a", None, 3), (None, 5, 4), (None, 5, 5)]
    ranked = with_ranks(spark.createDataFrame(data, "g string, v int, id int"), "g", "v", ["id"])
    assert rows(ranked, "id", "position", "value_rank", "group_rows") == [
        (1, 1, 1, 3), (2, 2, 2, 3), (3, 3, 2, 3), (4, 1, 1, 2), (5, 2, 1, 2)]
