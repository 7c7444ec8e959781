"""A further batch on top of the published version.

The outcome is that of a refresh over all batches together, but only what the batch touches is
written: the months that gain facts, and the months with facts of a prescriber whose history the
batch changes. All other months are taken over from the version before, which stays as it is for
its readers. Surrogate keys stay, new ones are numbered on.

A batch may correct the past: the accepted rows of its prescribers, those of earlier batches
included, are folded into versions anew, and the old and new time lines are compared stretch by
stretch. Facts that fall into a stretch with another version are moved to it. Lines that earlier
batches rejected are tried again, since the batch may hold the prescriber they miss.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.functions import text
from starloom.operators.calendar import build_dim_date, day_bounds
from starloom.operators.coerce import REASON
from starloom.operators.positions import with_keys
from starloom.operators.resolve import unique_lookup, version_segments
from starloom.plans import dimensions as dims
from starloom.plans.facts import annotate_fact, split_ready
from starloom.plans.refresh import (
    LOADED_IN,
    RefreshError,
    annotate_people,
    export_rejects,
    fact_rejects,
    for_each,
    gate,
)
from starloom.schemas import FACT_FEEDS, FEEDS, HCP_FEED, OPEN_END, RX_FEED, FactFeed, Feed
from starloom.session import pin
from starloom.sources import tables
from starloom.sources.feeds import PLACE, read_staged, stage_feed
from starloom.sources.tables import (
    BY_PRESCRIBER,
    HCP_ROWS,
    LOADED,
    NO_MONTH,
    OUTCOME,
    REJECTED,
    Run,
    Warehouse,
    write_table,
)

SAME_VERSION = ("hcp_id", "valid_from", "decile", "territory_key")


# -------------------------------------------------------------------- dimensions
def extend_territories(existing: DataFrame, staged_hcp: DataFrame) -> DataFrame:
    """Territories of unseen codes, numbered on after the highest key."""
    unseen = staged_hcp.where(F.col("territory_code").isNotNull()).select(
        "territory_code").distinct().join(existing, "territory_code", "left_anti")
    highest = existing.agg(F.max("territory_key")).first()[0] or 0
    keyed = with_keys(unseen, ["territory_code"], "territory_key", start_after=highest)
    return existing.unionByName(keyed.select(
        *dims.territory_columns(F.col("territory_key"), F.col("territory_code"))))


def refold(existing: DataFrame, history: DataFrame, batch: DataFrame,
           same_day: str = "fail") -> DataFrame:
    """The dimension after the accepted rows ``batch``, given the accepted rows of before.

    Only the prescribers of the batch are folded, from all their rows. A version that begins the
    same day with the same values keeps its key.
    """
    people = pin(batch.select("hcp_id").distinct())
    rows = history.join(people, "hcp_id", "left_semi").unionByName(batch).withColumn(
        "_ordinal", F.struct(LOADED_IN, PLACE))
    folded = dims.hcp_versions(rows, ordinal_col="_ordinal", same_day=same_day)
    known = existing.select(*[F.col(c).alias(f"_{c}") for c in SAME_VERSION], "hcp_key")
    same = [folded[c].eqNullSafe(known[f"_{c}"]) for c in SAME_VERSION]
    matched = pin(folded.join(known, same, "left").drop(*known.columns[:-1]))
    highest = existing.agg(F.max("hcp_key")).first()[0] or 0
    opened = dims.key_new_versions(matched.where("hcp_key is null").drop("hcp_key"), highest)
    return (
        existing.join(people, "hcp_id", "left_anti")
        .unionByName(matched.where("hcp_key is not null"), allowMissingColumns=True)
        .unionByName(opened, allowMissingColumns=True))


def moved_stretches(before: DataFrame, after: DataFrame) -> DataFrame:
    """(old_key, new_key, new_territory, seg_from, seg_to): days on which another version holds.

    Both time lines of a prescriber are cut at the days on which either changes; between two cuts
    each has one version. Versions that are the same before and after need no look.
    """
    keys = ("hcp_id", "hcp_key", "valid_from", "valid_to", "territory_key")

    def marks(mine: DataFrame, other: DataFrame, name: str) -> DataFrame:
        changed = mine.select(*keys).join(other.select(*keys), list(keys), "left_anti")

        def mark(day, sign):
            return F.struct(day.alias("day"), *[
                ((F.col(c) * sign) if side == name else F.lit(0)).cast("long").alias(f"{side}_{c}")
                for side in ("old", "new") for c in ("hcp_key", "territory_key")])
        ends = F.when(F.col("valid_to") < F.lit(OPEN_END), mark(F.date_add("valid_to", 1), -1))
        return changed.select("hcp_id", F.inline(F.array_compact(F.array(
            mark(F.col("valid_from"), 1), ends))))

    both = marks(before, after, "old").unionByName(marks(after, before, "new"))
    sums = [c for c in both.columns if c not in ("hcp_id", "day")]
    days = both.groupBy("hcp_id", "day").agg(*[F.sum(c).alias(c) for c in sums])
    person = Window.partitionBy("hcp_id").orderBy("day")
    so_far = person.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = days.select(
        F.col("day").alias("seg_from"),
        F.coalesce(F.date_sub(F.lead("day").over(person), 1), F.lit(OPEN_END)).alias("seg_to"),
        *[F.sum(c).over(so_far).alias(c) for c in sums])
    return cut.where("old_hcp_key > 0 and new_hcp_key > 0 and old_hcp_key <> new_hcp_key").select(
        F.col("old_hcp_key").alias("old_key"), F.col("new_hcp_key").alias("new_key"),
        F.col("new_territory_key").alias("new_territory"), "seg_from", "seg_to")


def extend_dimensions(run: Run, base: Run, version: int) -> None:
    spark = run.spark
    staged = {f.name: read_staged(spark, run.staging(f.name)) for f in FEEDS}
    write_table(extend_territories(base.read("dim_territory"), staged[HCP_FEED.name]),
                run.table("dim_territory"))
    known = base.read("dim_date").select("full_date")
    first, last = day_bounds(known, *[
        staged[f.name].select(text.to_padded_day(F.col(f.date_col)).alias("full_date"))
        for f in FACT_FEEDS]).first()
    write_table(build_dim_date(spark, first, last), run.table("dim_date"))
    people = annotate_people(
        staged[HCP_FEED.name], spark.read.parquet(run.table("dim_territory")), version)
    tables.write_outcome(people, run.table(HCP_ROWS), [OUTCOME])
    accepted = tables.read_outcome(spark, run.table(HCP_ROWS), LOADED)
    write_table(refold(base.read("dim_hcp"), base.rows(HCP_ROWS, LOADED), accepted),
                run.table("dim_hcp"))
    dim_hcp = spark.read.parquet(run.table("dim_hcp"))
    write_table(version_segments(dim_hcp), run.table("hcp_stretches"))
    write_table(moved_stretches(base.read("dim_hcp"), dim_hcp), run.table("hcp_moves"))


# ------------------------------------------------------------------------- facts
def _months(rows: DataFrame) -> list[str]:
    """At most one per month of the calendar."""
    return sorted(r[0] for r in rows.select("year_month").distinct().collect())


def extend_fact(run: Run, base: Run, feed: FactFeed) -> list[tuple[str, str | None, str]]:
    """Write the months the batch touches; returns the manifest entries of the fact table."""
    spark, raw = run.spark, fact_rejects(base, feed).drop(REASON)
    lines = read_staged(spark, run.staging(feed.name)).select(*raw.columns).unionByName(raw)
    dim_date = spark.read.parquet(run.table("dim_date"))
    products = unique_lookup(base.read("dim_product"), "product_code", "product_key")
    fresh = pin(split_ready(annotate_fact(
        lines, feed, spark.read.parquet(run.table("hcp_stretches")), products, dim_date), feed))

    days = dim_date.select("date_key", F.col("full_date").alias("_day"))
    moves = spark.read.parquet(run.table("hcp_moves"))
    falls = (F.col("hcp_key") == F.col("old_key")) & F.col("_day").between(
        F.col("seg_from"), F.col("seg_to"))
    facts = base.read(feed.target)
    moved = facts.select("hcp_key", "date_key", "year_month").join(days, "date_key").join(
        moves, falls, "left_semi")
    touched = sorted({*_months(fresh.where(F.col(OUTCOME) == LOADED)), *_months(moved)})

    stay = facts.where(F.col("year_month").isin(touched)).join(days, "date_key").join(
        moves, falls, "left").withColumns({
            "hcp_key": F.coalesce("new_key", "hcp_key").cast(facts.schema["hcp_key"].dataType),
            "territory_key": F.coalesce("new_territory", "territory_key").cast(
                facts.schema["territory_key"].dataType)})
    rows = fresh.unionByName(
        stay.select(*facts.columns, F.lit(LOADED).alias(OUTCOME)), allowMissingColumns=True)
    highest = spark.read.parquet(run.table("dim_hcp")).agg(F.max("hcp_key")).first()[0]
    slices = tables.slices_per_month(
        fresh.count() + facts.where(F.col("year_month").isin(touched)).count(), len(touched))
    tables.write_outcome(
        tables.cluster_fact(rows, highest, max(len(touched), 1), slices, [OUTCOME]),
        run.table(feed.target), [OUTCOME, "year_month"])

    held = _months(facts.select("year_month")) if base.entries is None else None
    entries = taken_over(base, feed.target, held, touched)
    entries += [(feed.target, month, run.table(feed.target)) for month in (*touched, NO_MONTH)]
    if feed is RX_FEED:
        folder = run.table(BY_PRESCRIBER)
        tables.write_by_prescriber(
            tables.read_outcome(spark, run.table(feed.target), LOADED), folder)
        entries += taken_over(base, BY_PRESCRIBER, held, touched)
        entries += [(BY_PRESCRIBER, month, folder) for month in (*touched, NO_MONTH)]
    return entries


def taken_over(base: Run, table: str, held: list[str] | None,
               touched: list[str]) -> list[tuple[str, str | None, str]]:
    """The entries of ``base`` for the months of a table that the batch does not touch."""
    out = []
    for _, month, folder in (e for e in base.manifest() if e[0] == table):
        out += [(table, m, folder) for m in ([month] if month is not None else held)
                if m not in (*touched, NO_MONTH)]
    return out


def counted(run: Run, feed: FactFeed) -> dict[str, int]:
    return {o: run.rows(feed.target, o).count() for o in (LOADED, REJECTED)}


# --------------------------------------------------------------------------- batch
Stager = Callable[[Feed, str], int]


def append(spark: SparkSession, paths: dict[str, str], root: str,
           batch: str | None = None) -> dict:
    """Publish the version after the CSV feeds ``paths`` (any of the three) and return its counts.

    A ``batch`` that was published before changes nothing.
    """
    return append_staged(
        spark, lambda feed, folder: stage_feed(spark, paths.get(feed.name), feed, folder),
        root, batch)


def append_staged(spark: SparkSession, stage: Stager, root: str, batch: str | None = None) -> dict:
    """As ``append``, with ``stage`` landing each feed in the folder it is given."""
    warehouse = Warehouse(spark, root)
    if batch is not None and warehouse.holds(batch):
        return {"published": False}
    number, base = warehouse.latest()
    run = warehouse.new_run()
    staged = for_each(FEEDS, lambda feed: stage(feed, run.staging(feed.name)))
    extend_dimensions(run, base, number)
    entries = [e for e in base.manifest() if e[0] in ("dim_product", HCP_ROWS)]
    entries += [(name, None, run.table(name))
                for name in ("dim_date", "dim_territory", "dim_hcp", HCP_ROWS)]
    for of_feed in for_each(FACT_FEEDS, lambda feed: extend_fact(run, base, feed)).values():
        entries += of_feed
    run = Run(spark, run.path, entries)
    counts = {}
    for feed in FACT_FEEDS:
        before, now = counted(base, feed), counted(run, feed)
        counts[feed.name] = now
        if staged[feed.name] + sum(before.values()) != sum(now.values()):
            raise RefreshError(f"row-count reconciliation failed: {feed.name} {before} {now}")
    gate(run, base)
    export_rejects(run)
    return {"published": True, "version": warehouse.publish(run, batch), "run": run.path,
            "staged": staged, **counts}
