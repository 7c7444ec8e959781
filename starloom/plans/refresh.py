"""The full refresh: stage, build dimensions, load facts, check, publish.

Everything is written under a new run folder. A run becomes visible only when it is appended to
the warehouse's log of published runs, after reconciliation and the checks.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators import quality
from starloom.operators.calendar import build_dim_date
from starloom.operators.coerce import REASON
from starloom.operators.resolve import unique_lookup, version_segments
from starloom.plans import dimensions as dims
from starloom.plans.facts import NATURAL_KEYS, annotate_fact, split_ready, text_measures
from starloom.schemas import (
    CALL_FEED,
    FACT_FEEDS,
    FEEDS,
    HCP_FEED,
    RX_FEED,
    FactFeed,
    Feed,
)
from starloom.sources import tables
from starloom.sources.feeds import MALFORMED, PLACE, read_staged, stage_feed
from starloom.sources.tables import (
    HCP_ROWS,
    LOADED,
    OUTCOME,
    REJECTED,
    Run,
    Warehouse,
    write_table,
)


LOADED_IN = "loaded_in"


class RefreshError(RuntimeError):
    """The run must not be published."""


def for_each(feeds: Sequence[Feed], job: Callable[[Feed], Any]) -> dict[str, Any]:
    """Run independent feeds side by side, so that one fills the executors the other leaves idle."""
    with ThreadPoolExecutor(len(feeds)) as pool:
        return dict(zip([f.name for f in feeds], pool.map(job, feeds), strict=True))


def stage_all(spark: SparkSession, paths: dict[str, str], run: Run) -> dict[str, int]:
    """Land the three feeds as text tables; returns their row counts."""
    return for_each(FEEDS, lambda feed: stage_feed(
        spark, paths[feed.name], feed, run.staging(feed.name)))


def build_dimensions(spark: SparkSession, run: Run) -> dict[str, int]:
    """Write the four dimensions of the run. Returns the prescriber row accounting."""
    staged_hcp = read_staged(spark, run.staging(HCP_FEED.name))
    write_table(dims.dim_product(spark).coalesce(1), run.table("dim_product"))
    write_table(dims.dim_territory(staged_hcp), run.table("dim_territory"))
    first, last = dims.calendar_bounds(
        *[read_staged(spark, run.staging(f.name)) for f in FACT_FEEDS])
    write_table(build_dim_date(spark, first, last), run.table("dim_date"))

    people = annotate_people(staged_hcp, spark.read.parquet(run.table("dim_territory")), 0)
    tables.write_outcome(people, run.table(HCP_ROWS), [OUTCOME])

    clean = tables.read_outcome(spark, run.table(HCP_ROWS), LOADED)
    versions = dims.hcp_versions(clean, ordinal_col=PLACE)
    write_table(dims.key_new_versions(versions), run.table("dim_hcp"))
    write_table(version_segments(run.read("dim_hcp")), run.table("hcp_stretches"))
    return tables.outcome_counts(spark, run.table(HCP_ROWS))


def annotate_people(staged_hcp: DataFrame, territories: DataFrame, loaded_in: int) -> DataFrame:
    """Typed prescriber rows with reason and outcome; ``loaded_in`` orders them between batches."""
    broken = F.when(F.col(MALFORMED).isNotNull(), F.lit("malformed line"))
    annotated = dims.annotate_hcp(staged_hcp, territories).withColumn(
        REASON, F.coalesce(broken, REASON))
    return annotated.withColumn(LOADED_IN, F.lit(loaded_in)).withColumn(
        OUTCOME, F.when(F.col(REASON).isNull(), F.lit(LOADED)).otherwise(F.lit(REJECTED)))


def load_fact(spark: SparkSession, run: Run, feed: FactFeed, n_staged: int) -> dict[str, int]:
    """Type, resolve and write one feed: loaded and rejected lines in one pass."""
    staged, dim_date = read_staged(spark, run.staging(feed.name)), run.read("dim_date")
    products = unique_lookup(run.read("dim_product"), "product_code", "product_key")
    stretches = spark.read.parquet(run.table("hcp_stretches"))
    annotated = annotate_fact(staged, feed, stretches, products, dim_date)
    months = dim_date.select("year_month").distinct().count()
    slices = tables.slices_per_month(n_staged, months)
    # Keys are dense from 1, so their number is the highest one.
    versions = tables.row_count(spark, run.table("dim_hcp"))
    rows = tables.cluster_fact(split_ready(annotated, feed), versions, months, slices, [OUTCOME])
    tables.write_outcome(rows, run.table(feed.target), [OUTCOME, "year_month"])
    if feed is RX_FEED:
        tables.write_by_prescriber(run.read(feed.target), run.table(tables.BY_PRESCRIBER))
    return tables.outcome_counts(spark, run.table(feed.target))


def fact_rejects(run: Run, feed: FactFeed) -> DataFrame:
    """Rejected lines of a fact feed as they came, with the reason."""
    written = run.rows(feed.target, REJECTED)
    raw = [c for c in (*feed.columns, MALFORMED) if f"raw_{c}" in written.columns]
    return written.select(*[F.col(f"raw_{c}").alias(c) for c in raw], REASON)


def hcp_rejects(run: Run) -> DataFrame:
    written = run.rows(HCP_ROWS, REJECTED)
    return written.select(*HCP_FEED.columns, MALFORMED, REASON)


def all_rejects(run: Run) -> DataFrame:
    """Rejects of the three feeds in one frame; columns a feed does not have are null."""
    return stack_rejects({
        HCP_FEED.name: hcp_rejects(run), **{f.name: fact_rejects(run, f) for f in FACT_FEEDS}})


def stack_rejects(rejects: dict[str, DataFrame]) -> DataFrame:
    """Frames of unlike columns under each other, ``entity`` naming where a row comes from."""
    return reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [rows.withColumn("entity", F.lit(name)) for name, rows in rejects.items()])


def export_rejects(run: Run) -> dict[str, str]:
    """Reject tables as CSV with a header, one folder per fact feed."""
    paths = {}
    for feed in FACT_FEEDS:
        paths[feed.name] = f"{run.path}/rejects/{feed.name}"
        fact_rejects(run, feed).write.mode("overwrite").option("header", True).csv(
            paths[feed.name])
    return paths


def reconcile(staged: dict[str, int], outcomes: dict[str, dict[str, int]]) -> None:
    """Every staged line must be loaded or rejected."""
    lost = {
        name: (staged[name], counts) for name, counts in outcomes.items()
        if staged[name] != counts[LOADED] + counts[REJECTED]
    }
    if lost:
        raise RefreshError(f"row-count reconciliation failed: {lost}")


def audit_totals(run: Run, feed: FactFeed = RX_FEED, base: Run | None = None) -> DataFrame:
    """(person, product, day) groups where staged text differs from rejected text plus facts.

    Counts can balance while the wrong lines were rejected; totals per natural key cannot. What a
    run took over from ``base`` counts as staged.
    """
    measures = [m for m in feed.measures if m in (*feed.numeric, *feed.integer)]
    staged = text_measures(read_staged(run.spark, run.staging(feed.name)), feed, measures)
    if base is not None:
        staged = staged.unionByName(accounted(base, feed, measures))
    return quality.differing_totals(staged, accounted(run, feed, measures), NATURAL_KEYS, measures)


def accounted(run: Run, feed: FactFeed, measures: Sequence[str]) -> DataFrame:
    """Natural keys and measures of the rejected lines and the facts of a run."""
    loaded = (
        run.read(feed.target).join(run.read("dim_hcp").select("hcp_key", "hcp_id"), "hcp_key")
        .join(run.read("dim_product").select("product_key", "product_code"), "product_key")
        .join(run.read("dim_date").select("date_key", F.col("full_date").alias("day")), "date_key")
        .select(*NATURAL_KEYS, *measures))
    return text_measures(fact_rejects(run, feed), feed, measures).unionByName(loaded)


def gate(run: Run, base: Run | None = None) -> None:
    """Refuse a run that breaks a check or does not hold all that was staged on top of ``base``."""
    star = run.star()
    if star[RX_FEED.target].isEmpty():
        raise RefreshError("no prescriptions were loaded")
    bad = quality.failed(quality.warehouse_checks(star))
    if bad:
        raise RefreshError(f"quality checks failed: {bad}")
    whole = for_each(FACT_FEEDS, lambda feed: audit_totals(run, feed, base).isEmpty())
    for name in (n for n, same in whole.items() if not same):
        raise RefreshError(f"{name}: staged text differs from rejects plus facts")


def run(spark: SparkSession, paths: dict[str, str], root: str, publish: bool = True) -> dict:
    """Refresh the warehouse at ``root`` from the CSV feeds and return its statistics.

    ``paths`` maps hcp, prescriptions and sales_calls to files or folders.
    """
    started = time.time()
    warehouse = Warehouse(spark, root)
    current = warehouse.new_run()
    staged = stage_all(spark, paths, current)
    outcomes = {HCP_FEED.name: build_dimensions(spark, current)}
    facts_started = time.time()
    outcomes |= for_each(FACT_FEEDS, lambda feed: load_fact(
        spark, current, feed, staged[feed.name]))
    reconcile(staged, outcomes)
    gate(current)
    fact_seconds = round(time.time() - facts_started, 1)
    export_rejects(current)
    if publish:
        warehouse.publish(current)

    versions = current.read("dim_hcp").agg(
        F.count(F.lit(1)), F.count_if(~F.col("is_current"))).first()
    spread = quality.distribution(current.read("dim_hcp"), current.read("dim_date"))
    rx, calls = outcomes[RX_FEED.name], outcomes[CALL_FEED.name]
    hcp = outcomes[HCP_FEED.name]
    return {
        "run": current.path,
        "dim_hcp_rows": versions[0], "scd2_history_rows": versions[1],
        "staged_hcp": staged[HCP_FEED.name], "rejected_hcp": hcp[REJECTED],
        "staged_rx": staged[RX_FEED.name],
        "loaded_rx": rx[LOADED], "rejected_rx": rx[REJECTED],
        "staged_calls": staged[CALL_FEED.name],
        "loaded_calls": calls[LOADED], "rejected_calls": calls[REJECTED],
        "spread": {r["measure"]: r["value"] for r in spread.collect()},
        "fact_load_s": fact_seconds, "elapsed_s": round(time.time() - started, 1),
    }

