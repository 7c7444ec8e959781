"""Times the registered queries, the full refresh, and the reports on the refreshed warehouse.

Prints one JSON line. ``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. As in the
baseline, a query is run once to warm up and then reported as the median of ``BENCH_RUNS`` runs.
The refresh reads CSV feeds written beforehand from the same tables; its first run, in a session
that has run nothing yet, is reported as ``etl_refresh_cold`` and its second as ``etl_refresh``.
``stored_prescriber_drilldown`` takes the access path beside the facts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from starloom import bindings  # noqa: E402
from starloom.plans import refresh, reports  # noqa: E402
from starloom.queries import registered  # noqa: E402
from starloom.schemas import CALL_FEED, CALL_TYPES, HCP_FEED, PRODUCTS, RX_FEED  # noqa: E402
from starloom.session import local_session  # noqa: E402
from starloom.sources.tables import Warehouse  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
NOT_ADDED = ("etl_refresh_cold", "etl_fact_load_and_checks")
FEED_COPIES = int(os.environ.get("BENCH_FEED_COPIES", "5"))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
DIRT = 9_000


def write_feeds(spark: SparkSession, folder: str) -> dict[str, str]:
    """The three CSV feeds: order lines as prescriptions, orders as calls, customers as prescribers.

    Lines and customers are taken ``FEED_COPIES`` times, each time as other people, which at sf0.1
    gives about as many prescriptions as the baseline loaded (2.2 million).
    """
    people = bindings.table(spark, SF_DIR, "customer")
    n_people = people.count()
    copies = F.explode(F.sequence(F.lit(0), F.lit(FEED_COPIES - 1)))
    codes = F.array(*[F.lit(p[0]) for p in PRODUCTS])
    kinds = F.array(*[F.lit(k) for k in CALL_TYPES])

    def pick(values, key, size):
        return F.element_at(values, (F.col(key) % size + 1).cast("int"))

    lines = bindings.table(spark, SF_DIR, "lineitem").join(
        bindings.table(spark, SF_DIR, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    person = F.format_string("HCP-%05d", F.col("o_custkey") + F.col("copy") * n_people)
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    rx = lines.withColumn("copy", copies).groupBy(
        day.alias("rx_date"), person.alias("hcp_id"),
        pick(codes, "l_partkey", len(PRODUCTS)).alias("product_code"),
    ).agg(
        F.sum("l_quantity").cast("int").alias("trx_count"),
        F.floor(F.sum("l_quantity") / 3).alias("nrx_count"),
        F.sum("l_quantity").cast("decimal(12,2)").alias("units"),
        F.sum(F.col("l_extendedprice").cast("decimal(12,2)")).alias("gross_sales"))
    # One line in DIRT has no number for its volume, another one no known product.
    mark = F.pmod(F.xxhash64("rx_date", "hcp_id", "product_code"), F.lit(DIRT))
    rx = rx.withColumns({
        "trx_count": F.when(mark == 0, "N/A").otherwise(F.col("trx_count").cast("string")),
        "product_code": F.when(mark == 1, "UNKNOWN-99").otherwise(F.col("product_code"))})
    calls = bindings.table(spark, SF_DIR, "orders").withColumn("copy", F.lit(0)).select(
        day.alias("call_date"), person.alias("hcp_id"),
        pick(codes, "o_orderkey", 3).alias("product_code"),
        pick(kinds, "o_orderkey", len(CALL_TYPES)).alias("call_type"),
        F.lit("15").alias("duration_minutes"), F.lit("1").alias("samples_dropped"))
    hcp = people.withColumn("o_custkey", F.col("c_custkey")).withColumn("copy", copies).select(
        person.alias("hcp_id"), F.col("c_name").alias("full_name"),
        F.col("c_mktsegment").alias("specialty"),
        F.inline(F.array(
            F.struct((F.col("c_custkey") % 10 + 1).alias("decile"),
                     F.lit("1995-01-01").alias("effective_date")),
            F.struct((F.col("c_nationkey") % 10 + 1).alias("decile"),
                     F.lit("1998-01-01").alias("effective_date")))),
        F.format_string("T-%03d", "c_nationkey").alias("territory_code"))
    paths = {}
    for feed, df in ((HCP_FEED, hcp), (RX_FEED, rx), (CALL_FEED, calls)):
        paths[feed.name] = f"{folder}/{feed.name}"
        df.select(*feed.columns).write.option("header", True).csv(paths[feed.name])
    return paths


def seconds(build: Callable[[], DataFrame]) -> float:
    started = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def median(build: Callable[[], DataFrame]) -> float:
    seconds(build)
    return round(statistics.median(seconds(build) for _ in range(RUNS)), 3)


def main() -> None:
    spark = local_session("bench", cores=CPUS, shuffle_partitions=int(CPUS), memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    timings = {}
    with tempfile.TemporaryDirectory(prefix="starloom-bench-") as folder:
        paths = write_feeds(spark, folder)
        cold = refresh.run(spark, paths, f"{folder}/warehouse")
        timings["etl_refresh_cold"] = cold["elapsed_s"]
        stats = refresh.run(spark, paths, f"{folder}/warehouse")
        timings["etl_refresh"] = stats["elapsed_s"]
        timings["etl_fact_load_and_checks"] = stats["fact_load_s"]
        published = Warehouse(spark, f"{folder}/warehouse").current()
        star = published.star()
        for name, report in reports.REPORTS.items():
            timings[f"stored_{name}"] = median(lambda r=report: r(star))
        timings["stored_prescriber_drilldown"] = median(lambda: reports.stored_drilldown(published))
        for name, query in registered().items():
            timings[name] = median(lambda q=query: q(spark, SF_DIR))
    staged = stats["staged_rx"] + stats["staged_calls"]
    print(json.dumps({
        "metric": "total of query medians and one full refresh",
        "value": round(sum(v for k, v in timings.items() if k not in NOT_ADDED), 3),
        "unit": "sec", "queries": timings, "sf": Path(SF_DIR).name.removeprefix("sf"),
        "etl_fact_rows": staged,
        "etl_rows_per_sec": round(staged / stats["elapsed_s"]),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
