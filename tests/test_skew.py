"""A third of the rows on one key, dimensions too large to broadcast: same result, hot key split."""

import random

import pytest
from helpers import OPEN, day, rows
from pyspark.sql import functions as F

from starloom.operators.calendar import build_dim_date
from starloom.operators.coerce import REASON
from starloom.operators.resolve import annotate_keys, unique_lookup, version_segments
from starloom.plans import reports
from starloom.session import pin

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
    "spark.sql.shuffle.partitions": "12",
}


@pytest.fixture
def no_broadcast(spark):
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot(rng, size):
    """0 for a third of the draws, else evenly among the others."""
    return 0 if rng.random() < 1 / 3 else rng.randrange(1, size)


def test_resolution_splits_a_hot_person(spark, no_broadcast, tmp_path):
    rng = random.Random(1)
    facts = [(f"2024-{rng.randrange(1, 13):02d}-{rng.randrange(1, 29):02d}",
              f"H{hot(rng, 300)}", f"P{rng.randrange(8)}", i) for i in range(20000)]
    path = str(tmp_path / "facts")
    spark.createDataFrame(
        facts, "rx_date string, hcp_id string, product_code string, n int"
    ).repartition(16).write.parquet(path)
    versions = [(f"H{i}", 2 * i + late, 10 * i + late,
                 day("2024-06-01" if late else "2024-01-01"), OPEN if late else day("2024-05-31"))
                for i in range(300) for late in (0, 1)]
    dim_hcp = spark.createDataFrame(
        versions, "hcp_id string, hcp_key int, territory_key int, valid_from date, valid_to date")
    products = spark.createDataFrame([(f"P{i}", i) for i in range(8)],
                                     "product_code string, product_key int")
    annotated = annotate_keys(
        spark.read.parquet(path), pin(version_segments(dim_hcp)),
        unique_lookup(products, "product_code", "product_key"),
        build_dim_date(spark, "2024-01-01", "2024-12-31"), "rx_date")
    found = {r.n: (r.hcp_key, r.territory_key, r[REASON]) for r in annotated.collect()}
    assert found == {
        n: (2 * int(h[1:]) + (d >= "2024-06"), 10 * int(h[1:]) + (d >= "2024-06"), None)
        for d, h, _, n in facts}
    final = annotated._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    on_person = [line for line in final.splitlines() if "SortMergeJoin" in line and "hcp_id" in line]
    assert on_person and all("skew=true" in line for line in on_person)


def test_reports_with_a_hot_prescriber_and_territory(spark, no_broadcast):
    rng = random.Random(2)
    rx = [(20240101 + rng.randrange(28), hot(rng, 200) + 1, rng.randrange(2) + 1, 0, 1)
          for _ in range(6000)]
    rx = [(d, h, p, 1 if h % 3 else 2, t) for d, h, p, _, t in rx]
    fact = spark.createDataFrame(
        rx, "date_key int, hcp_key int, product_key int, territory_key int, trx_count int")
    star = {
        "fact_prescriptions": fact,
        "dim_product": spark.createDataFrame(
            [(1, "Own", False, "A"), (2, "Other", True, "A")],
            "product_key int, brand_name string, is_competitor boolean, therapeutic_area string"),
        "dim_hcp": spark.createDataFrame([(i, f"H{i}", "n", "s") for i in range(1, 201)],
                                         "hcp_key int, hcp_id string, full_name string, "
                                         "specialty string"),
        "dim_territory": spark.createDataFrame([(1, "T1"), (2, "T2")],
                                               "territory_key int, territory_name string"),
    }
    fact.where("product_key = 1").createOrReplaceTempView("own_rx")
    plain = spark.sql("""
        with v as (select concat('H', hcp_key) hcp_id, hcp_key, territory_key, sum(trx_count) t
                   from own_rx group by all)
        select hcp_id, t, ntile(10) over (partition by territory_key order by t desc, hcp_key),
               rank() over (partition by territory_key order by t desc) from v""")
    ranked = reports.prescriber_ranking(star).select(
        "hcp_id", F.col("total_trx"), "calculated_decile", "territory_rank")
    assert rows(ranked) == rows(plain)
