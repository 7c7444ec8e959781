"""The registered queries: each operator and report over the whole benchmark tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom import bindings as b
from starloom.functions import text
from starloom.functions.dates import year_month
from starloom.operators import quality
from starloom.operators.calendar import calendar_over, day_bounds
from starloom.operators.coerce import REASON, annotate_types, coerce_columns, with_typed_columns
from starloom.operators.exposure import (
    person_days,
    prior_calls_by_range_join,
    with_prior_calls,
)
from starloom.operators.resolve import resolve_surrogate_keys, version_segments
from starloom.operators.scans import with_scans
from starloom.operators.scd2 import apply_scd2, scd2_conflicts
from starloom.operators.selection import distinct_ids, medians
from starloom.plans import dimensions, reports
from starloom.plans.append import refold
from starloom.plans.facts import (
    NATURAL_KEYS,
    annotate_fact,
    reconciliation,
    split_ready,
    text_measures,
)
from starloom.plans.refresh import LOADED_IN, stack_rejects
from starloom.schemas import CALL_FEED, DRILLDOWN_HCP_KEY, HCP_FEED, RX_FEED, Feed
from starloom.session import pin, shared_folder
from starloom.sources.feeds import MALFORMED, PLACE, read_csv
from starloom.sources.tables import LOADED, OUTCOME, REJECTED, read_prescriber, write_by_prescriber

Query = Callable[[SparkSession, str], DataFrame]
ORDER_HISTORY = dict(business_key="hcp_id", tracked=("priority", "status"),
                     effective_col="effective_date", ordinal_col="ordinal")
SECOND_BATCH_FROM = "1998-06-01"
TOTALLED = ("trx_count", "units", "gross_sales")


def plain(df: DataFrame) -> DataFrame:
    """Days as text, whole numbers as long and decimals as double, for comparing results."""
    def shown(field: T.StructField):
        kind, value = field.dataType, F.col(field.name)
        if isinstance(kind, T.DecimalType):
            return value.cast("double").alias(field.name)
        if isinstance(kind, T.DateType):
            return value.cast("string").alias(field.name)
        if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
            return value.cast("bigint").alias(field.name)
        return value
    return df.select(*[shown(f) for f in df.schema.fields])


# --------------------------------------------------------------------- reports
def brand_share_mom(spark: SparkSession, d: str) -> DataFrame:
    return reports.brand_share_mom(b.rx_star(spark, d, territory=False))


def prescriber_ranking(spark: SparkSession, d: str) -> DataFrame:
    return reports.prescriber_ranking(b.rx_star(spark, d))


def territory_attainment(spark: SparkSession, d: str) -> DataFrame:
    return reports.territory_attainment(b.rx_star(spark, d))


def call_effectiveness(spark: SparkSession, d: str) -> DataFrame:
    return reports.call_effectiveness(b.contact_star(spark, d))


def monthly_brand_rollup(spark: SparkSession, d: str) -> DataFrame:
    return reports.monthly_brand_rollup(b.rx_star(spark, d, territory=False))


def prescriber_drilldown(spark: SparkSession, d: str) -> DataFrame:
    return reports.prescriber_drilldown(b.rx_star(spark, d, territory=False))


# -------------------------------------------------------------------- exposure
def exposure_days(spark: SparkSession, d: str) -> DataFrame:
    return with_prior_calls(person_days(*b.scripts_and_calls(spark, d)))


def exposure_days_range_join(spark: SparkSession, d: str) -> DataFrame:
    return prior_calls_by_range_join(*b.scripts_and_calls(spark, d))


# ---------------------------------------------------------------------- typing
def _coerced(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return coerce_columns(b.rx_text(spark, d), numeric=RX_FEED.numeric, integer=RX_FEED.integer,
                          dates=RX_FEED.dates)


def coerce_clean(spark: SparkSession, d: str) -> DataFrame:
    return _coerced(spark, d)[0]


def coerce_rejects(spark: SparkSession, d: str) -> DataFrame:
    return _coerced(spark, d)[1]


def coerce_reject_summary(spark: SparkSession, d: str) -> DataFrame:
    annotated = annotate_types(b.rx_text(spark, d), **RX_FEED.rules())
    return annotated.groupBy(F.coalesce(REASON, F.lit("clean")).alias(REASON)).agg(
        F.count(F.lit(1)).alias("lines"))


# ------------------------------------------------------------------ dimensions
def calendar_dim(spark: SparkSession, d: str) -> DataFrame:
    shipped = b.rx_text(spark, d).select(text.to_padded_day(F.col("rx_date")))
    ordered = b.table(spark, d, "orders").select(F.col("o_orderdate").cast("date"))
    return calendar_over(day_bounds(shipped, ordered))


def territory_dim(spark: SparkSession, d: str) -> DataFrame:
    code = F.concat(F.lit("T-"), F.lpad(F.col("c_nationkey").cast("string"), 3, "0"))
    return dimensions.dim_territory(
        b.table(spark, d, "customer").select(code.alias("territory_code")))


def _hcp_rows(spark: SparkSession, d: str) -> DataFrame:
    staged = b.hcp_text(spark, d)
    return dimensions.annotate_hcp(staged, dimensions.dim_territory(staged))


def hcp_dimension(spark: SparkSession, d: str) -> DataFrame:
    return dimensions.key_new_versions(dimensions.hcp_versions(
        _hcp_rows(spark, d), ordinal_col="ordinal", same_day="first"))


def hcp_rejects(spark: SparkSession, d: str) -> DataFrame:
    rejected = _hcp_rows(spark, d).where(F.col(REASON).isNotNull())
    return rejected.select(*HCP_FEED.columns, REASON)


def scd2_versions(spark: SparkSession, d: str) -> DataFrame:
    return apply_scd2(None, b.order_changes(spark, d), same_day="first", **ORDER_HISTORY)


def scd2_conflicts_found(spark: SparkSession, d: str) -> DataFrame:
    return scd2_conflicts(None, b.order_changes(spark, d), **ORDER_HISTORY)


def scd2_incremental(spark: SparkSession, d: str) -> DataFrame:
    changes = b.order_changes(spark, d)
    later = F.col("effective_date") >= F.lit(SECOND_BATCH_FROM).cast("date")
    first = apply_scd2(None, changes.where(~later), same_day="first", **ORDER_HISTORY)
    return apply_scd2(first, changes.where(later), same_day="first", **ORDER_HISTORY)


# ------------------------------------------------------------------ resolution
def _resolved(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    clean, _ = _coerced(spark, d)
    return resolve_surrogate_keys(clean, b.order_windows(spark, d), b.product_codes(spark, d),
                                  b.order_calendar(spark, d))


def resolve_keys(spark: SparkSession, d: str) -> DataFrame:
    return _resolved(spark, d)[0]


def resolve_rejects(spark: SparkSession, d: str) -> DataFrame:
    return _resolved(spark, d)[1]


def label_as_of(spark: SparkSession, d: str) -> DataFrame:
    """Shipped lines by the customer's status and priority on the day of shipping."""
    history = scd2_versions(spark, d)
    lines = b.table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_shipdate").cast("date").alias("day"),
        F.col("l_quantity").cast("int").alias("trx_count"))
    lines = lines.join(b.orders_by_person(spark, d, territory=False).drop("day"), "o_orderkey")
    per_day = lines.groupBy(F.col("hcp_key").alias("hcp_id"), "day").agg(
        F.sum("trx_count").alias("trx"), F.count(F.lit(1)).alias("lines"))
    labelled = reports.label_as_of(per_day, history, "day", "priority", "status")
    return labelled.groupBy("priority", "status", year_month(F.col("day")).alias("year_month")).agg(
        F.sum("lines").alias("lines"), F.sum("trx").alias("trx"))


def _annotated(spark: SparkSession, d: str, staged: DataFrame) -> DataFrame:
    return annotate_fact(staged, RX_FEED, pin(version_segments(b.order_windows(spark, d))),
                         b.product_codes(spark, d), b.order_calendar(spark, d))


def _rx_annotated(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    staged = b.rx_text(spark, d)
    return staged, _annotated(spark, d, staged)


def reconcile(spark: SparkSession, d: str) -> DataFrame:
    rx, rx_annotated = _rx_annotated(spark, d)
    calls, calls_annotated = _calls_annotated(spark, d)
    return reconciliation("prescriptions", rx, rx_annotated).unionByName(
        reconciliation("sales_calls", calls, calls_annotated))


# ---------------------------------------------------------------------- checks
def fk_orphans(spark: SparkSession, d: str) -> DataFrame:
    """References into the whole dimensions; days of the text feed and of shipping may lie outside."""
    customer = customers = b.table(spark, d, "customer")
    parts = b.table(spark, d, "part")
    suppliers = b.table(spark, d, "supplier")
    nations = b.table(spark, d, "nation")
    days = b.order_calendar(spark, d)
    orders = b.table(spark, d, "orders")
    lines = b.table(spark, d, "lineitem").select(
        F.col("l_partkey").alias("p_partkey"), F.col("l_suppkey").alias("s_suppkey"),
        F.date_format(F.col("l_shipdate"), "yyyyMMdd").cast("int").alias("date_key"))
    stray = F.hash("product_code")  # an unknown code is no number, so it gets one no part has
    feed = b.rx_text(spark, d).select(F.coalesce(
        F.col("product_code").try_cast("bigint"), -F.abs(stray.cast("bigint")) - 1).alias("p_partkey"))
    rows = {"feed": feed, "lineitem": lines, "orders": orders.withColumnRenamed("o_custkey", "c_custkey"),
            "customer": customer.withColumnRenamed("c_nationkey", "n_nationkey")}
    return quality.orphans(
        rows,
        {"p_partkey": parts, "s_suppkey": suppliers, "date_key": days, "c_custkey": customers,
         "n_nationkey": nations},
        {"feed": ("p_partkey",), "lineitem": ("p_partkey", "s_suppkey", "date_key"), "orders": ("c_custkey",),
         "customer": ("n_nationkey",)})


def null_and_range_checks(spark: SparkSession, d: str) -> DataFrame:
    """Order lines under the fact rules, before any line was rejected."""
    lines = with_typed_columns(annotate_types(b.rx_text(spark, d), **RX_FEED.rules()))
    measures = ("trx_count", "nrx_count", "units", "gross_sales")
    windows = b.order_windows(spark, d)
    return quality.count_rows_where(lines, {
        **quality.nulls("fact", (*measures, "hcp_id", "rx_date")),
        "small or negative measure": (F.col("units") < 2) | (F.col("trx_count") < 2),
        "nrx above a third of units": F.col("nrx_count") * 3 > F.col("units"),
    }).unionByName(quality.count_rows_where(windows, {
        "inverted window": F.col("valid_from") > F.col("valid_to"),
        "territory outside 1..20": ~F.col("territory_key").between(1, 20),
    }))


def row_condition_checks(spark: SparkSession, d: str) -> DataFrame:
    """The publish gate's own row conditions, over order lines and events that break them."""
    lines = b.table(spark, d, "lineitem")
    orders = b.table(spark, d, "orders")
    people = b.table(spark, d, "customer").select("c_custkey", "c_nationkey")
    margin = F.col("l_extendedprice") * (F.col("l_discount") - F.col("l_tax"))
    prescribed = lines.select(
        F.date_format("l_shipdate", "yyyyMMdd").cast("int").alias("date_key"),
        F.col("l_orderkey").alias("hcp_key"), F.col("l_partkey").alias("product_key"),
        F.col("l_suppkey").alias("territory_key"), F.col("l_quantity").alias("trx_count"),
        F.col("l_linenumber").alias("nrx_count"), F.col("l_extendedprice").alias("units"),
        margin.alias("gross_sales"))
    call_type = F.when(F.col("event_type") == "click", "DETAIL").otherwise(F.col("event_type"))
    calls = b.table(spark, d, "events").join(
        people, F.col("user_id") == F.col("c_custkey"), "left").select(
        F.date_format("ts", "yyyyMMdd").cast("int").alias("date_key"),
        F.col("user_id").alias("hcp_key"), F.col("event_id").alias("product_key"),
        F.col("c_nationkey").alias("territory_key"), call_type.alias("call_type"),
        F.col("value").alias("duration_minutes"), F.col("value").alias("samples_dropped"))
    versions = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").alias("hcp_key"), F.col("o_custkey").alias("hcp_id"),
        F.col("l_returnflag").alias("full_name"), F.col("l_linestatus").alias("specialty"),
        F.col("l_suppkey").alias("territory_key"), F.col("l_quantity").alias("decile"),
        F.col("l_shipdate").cast("date").alias("valid_from"),
        F.date_add(F.col("o_orderdate").cast("date"), 30).alias("valid_to"),
        (F.col("o_orderstatus") == "O").alias("is_current"))
    star = {"fact_prescriptions": prescribed, "fact_sales_calls": calls, "dim_hcp": versions}
    return quality.stack([quality.count_rows_where(rows, quality.row_conditions(t))
                          for t, rows in star.items()])


def scd2_invariants(spark: SparkSession, d: str) -> DataFrame:
    windows = b.order_windows(spark, d)
    orders = b.table(spark, d, "orders").select("o_orderkey")
    shipped = b.table(spark, d, "lineitem").join(
        orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").alias("hcp_key"),
        F.date_format(F.col("l_shipdate"), "yyyyMMdd").cast("int").alias("date_key"))
    return quality.stack([
        quality.not_one_current(windows),
        quality.overlapping_versions(windows),
        quality.facts_outside_version({"lineitem": shipped}, windows, b.order_calendar(spark, d)),
        quality.scalars(windows, {"closed versions": F.count_if(~F.col("is_current"))}),
    ])


def uniqueness_checks(spark: SparkSession, d: str) -> DataFrame:
    keys = {"orders": ("o_orderkey",), "customer": ("c_custkey",), "part": ("p_partkey",)}
    return quality.stack([
        quality.repeated_keys({t: b.table(spark, d, t) for t in keys}, keys),
        quality.duplicates("lineitem (order, line) is repeated", b.table(spark, d, "lineitem"),
                           ["l_orderkey", "l_linenumber"]),
        quality.duplicates("prescription grain is repeated", b.prescriptions(spark, d, False),
                           ["hcp_key", "product_key", "date_key"]),
    ])


def distribution_checks(spark: SparkSession, d: str) -> DataFrame:
    versions = scd2_versions(spark, d).select(
        F.concat("priority", "status").alias("decile"), "is_current")
    return quality.distribution(versions, b.order_calendar(spark, d))


def _differing_totals(spark: SparkSession, d: str, product: Column) -> DataFrame:
    """(person, product, day) groups where staged text differs from rejected text plus facts, which
    stand under ``product``.

    The source does not pass through the verdict, so a line that is lost or changed on its way shows.
    Staged lines and the load's outcome are written down first, as a refresh does, so that the audit
    reads them and neither the feed nor the keys are worked out again for each of its sides.
    """
    staged = pin(b.rx_text(spark, d))
    written = pin(split_ready(_annotated(spark, d, staged), RX_FEED))
    facts = written.where(F.col(OUTCOME) == LOADED)
    rejects = written.where(F.col(OUTCOME) == REJECTED).select(
        *[F.col(f"raw_{c}").alias(c) for c in RX_FEED.columns])
    days = b.order_calendar(spark, d).select("date_key", F.col("full_date").alias("day"))
    loaded = (
        facts.join(b.order_windows(spark, d).select("hcp_key", "hcp_id"), "hcp_key")
        .join(b.product_codes(spark, d), "product_key").join(days, "date_key")
        .withColumn("product_code", product).select(*NATURAL_KEYS, *TOTALLED))
    return quality.differing_totals(
        text_measures(staged, RX_FEED, TOTALLED),
        text_measures(rejects, RX_FEED, TOTALLED).unionByName(loaded), NATURAL_KEYS, TOTALLED)


def source_vs_warehouse(spark: SparkSession, d: str) -> DataFrame:
    return _differing_totals(spark, d, F.col("product_code"))


def source_vs_damaged_warehouse(spark: SparkSession, d: str) -> DataFrame:
    """The same audit over a warehouse whose one-script facts stand under another product."""
    moved = F.when(F.col("trx_count") <= 1, F.lit("MOVED")).otherwise(F.col("product_code"))
    return _differing_totals(spark, d, moved)


# ------------------------------------------------------------------- load path
def quoted_feed(spark: SparkSession, d: str) -> DataFrame:
    """Documents as a CSV feed whose texts hold line breaks, quotes and commas, staged again."""
    feed = Feed(name="documents", columns=("doc_id", "lang", "source", "text"), dates=())
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    b.table(spark, d, "documents").select(*feed.columns).write.option("header", True).option(
        "escape", '"').csv(path)
    return read_csv(spark, path, feed).select(*feed.columns, MALFORMED)


def fact_load(spark: SparkSession, d: str) -> DataFrame:
    """Every prescription line as it is written: typed and keyed, or raw with its reason."""
    _, annotated = _rx_annotated(spark, d)
    return split_ready(annotated, RX_FEED)


def _calls_annotated(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    calls, events = b.call_text(spark, d), b.contacts(spark, d)
    codes = events.select("product_code").distinct().select(
        F.col("product_code").cast("string").alias("product_code"),
        F.col("product_code").alias("product_key"))
    versions = b.contact_versions(events).withColumn("hcp_id", F.col("hcp_id").cast("string"))
    return calls, annotate_fact(calls, CALL_FEED, pin(version_segments(versions)), codes,
                                calendar_over(day_bounds(events.select("day"))))


def reject_sink(spark: SparkSession, d: str) -> DataFrame:
    """Rejected lines of the three feeds in one frame, each with the columns of its feed."""
    lines = [(HCP_FEED, _hcp_rows(spark, d)), (RX_FEED, _rx_annotated(spark, d)[1]),
             (CALL_FEED, _calls_annotated(spark, d)[1])]
    return stack_rejects({
        feed.name: rows.where(F.col(REASON).isNotNull()).select(*feed.columns, REASON)
        for feed, rows in lines})


def literal_products(spark: SparkSession, d: str) -> DataFrame:
    """Order lines dealt to the fixed products."""
    products = dimensions.dim_product(spark)
    key = (F.col("l_partkey") % 8 + 1).alias("product_key")
    return b.table(spark, d, "lineitem").select(key, "l_quantity").join(
        products, "product_key").groupBy("product_code", "brand_name", "is_competitor").agg(
        F.sum(F.col("l_quantity").cast("int")).alias("trx"))


def corrected_history(spark: SparkSession, d: str) -> DataFrame:
    """The prescriber dimension from two batches, of which the second corrects the past of the first."""
    rows = _hcp_rows(spark, d).where(F.col(REASON).isNull()).withColumn(
        PLACE, F.struct("ordinal")).withColumn(LOADED_IN, F.lit(0))
    late = F.col("ordinal") % 3 == 0
    first, second = pin(rows.where(~late)), pin(rows.where(late))
    start = dimensions.key_new_versions(dimensions.hcp_versions(
        first, ordinal_col=PLACE, same_day="first"))
    return refold(pin(start), first, second, same_day="first").drop("hcp_key")


def dimension_checks(spark: SparkSession, d: str) -> DataFrame:
    """The gate's row conditions over calendar, products and territories with holes."""
    size = F.col("p_size")
    products = b.table(spark, d, "part").select(
        F.col("p_partkey").alias("product_key"), F.col("p_name").alias("product_code"),
        F.when(size > 5, F.col("p_brand")).alias("brand_name"),
        F.when(size > 10, F.col("p_type")).alias("molecule"),
        F.col("p_type").alias("therapeutic_area"), F.when(size < 49, size > 20).alias("is_competitor"))
    places = b.table(spark, d, "customer").select(
        F.when(F.col("c_custkey") % 9 > 0, F.col("c_custkey")).alias("territory_key"),
        F.col("c_name").alias("territory_code"), F.col("c_mktsegment").alias("territory_name"),
        F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")).alias("region"),
        F.lit("India").alias("country"))
    rows = {"dim_date": b.order_calendar(spark, d), "dim_product": products, "dim_territory": places}
    return quality.stack([quality.count_rows_where(table, quality.row_conditions(name))
                          for name, table in rows.items()])


def stored_drilldown(spark: SparkSession, d: str) -> DataFrame:
    """The drill-down by its access path, built from all prescriptions."""
    folder = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    write_by_prescriber(b.prescriptions(spark, d, False), folder)
    return read_prescriber(spark, folder, DRILLDOWN_HCP_KEY).groupBy("year_month").agg(
        F.sum("trx").alias("trx"))


# ----------------------------------------------------------------- large groups
def scanned_lines(spark: SparkSession, d: str) -> DataFrame:
    """Order lines of a brand in order: price of the line before, volume to date, change of status."""
    parts = b.table(spark, d, "part").select("p_partkey", "p_brand")
    lines = b.table(spark, d, "lineitem").join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("p_brand").alias("brand"), F.col("l_shipdate").cast("date").alias("day"),
        F.col("l_orderkey").alias("order_key"), F.col("l_linenumber").alias("line"),
        F.col("l_quantity").cast("long").alias("trx"), F.col("l_extendedprice").alias("price"),
        "l_returnflag", "l_linestatus")
    return with_scans(
        lines, ["brand"], ["day", "order_key", "line"], {"price_before": "price"},
        {"trx_to_date": "trx"}, {"changed": ["l_returnflag", "l_linestatus"]})


def median_prices(spark: SparkSession, d: str) -> DataFrame:
    """Median price of the order lines of each brand, in whole cents."""
    parts = b.table(spark, d, "part").select("p_partkey", F.col("p_brand").alias("brand"))
    cents = F.rint(F.col("l_extendedprice") * 100).cast("long").alias("cents")
    lines = b.table(spark, d, "lineitem").select("l_partkey", cents, F.lit(1).alias("n"))
    found = medians(lines.join(parts, F.col("l_partkey") == F.col("p_partkey")), ["brand"], "cents", "n")
    return found.select("brand", ((F.col("low") + F.col("high")) / 2).alias("median_cents"))


def distinct_buyers(spark: SparkSession, d: str) -> DataFrame:
    """Different customers per brand and month, per brand, per month and in all."""
    rx = b.prescriptions(spark, d, False).join(
        b.products(spark, d).select("product_key", "brand_name"), "product_key")
    return distinct_ids(rx, "hcp_key", [
        ["brand_name", "year_month"], ["brand_name"], ["year_month"], []])


QUERIES: dict[str, Query] = {
    "brand_share_mom": brand_share_mom,
    "prescriber_ranking": prescriber_ranking,
    "territory_attainment": territory_attainment,
    "call_effectiveness": call_effectiveness,
    "monthly_brand_rollup": monthly_brand_rollup,
    "prescriber_drilldown": prescriber_drilldown,
    "exposure_days": exposure_days,
    "exposure_days_range_join": exposure_days_range_join,
    "coerce_clean": coerce_clean,
    "coerce_rejects": coerce_rejects,
    "coerce_reject_summary": coerce_reject_summary,
    "calendar_dim": calendar_dim,
    "territory_dim": territory_dim,
    "hcp_dimension": hcp_dimension,
    "hcp_rejects": hcp_rejects,
    "scd2_versions": scd2_versions,
    "scd2_conflicts": scd2_conflicts_found,
    "scd2_incremental": scd2_incremental,
    "resolve_keys": resolve_keys,
    "resolve_rejects": resolve_rejects,
    "label_as_of": label_as_of,
    "reconcile": reconcile,
    "fk_orphans": fk_orphans,
    "null_and_range_checks": null_and_range_checks,
    "row_condition_checks": row_condition_checks,
    "scd2_invariants": scd2_invariants,
    "uniqueness_checks": uniqueness_checks,
    "distribution_checks": distribution_checks,
    "source_vs_warehouse": source_vs_warehouse,
    "source_vs_damaged_warehouse": source_vs_damaged_warehouse,
    "quoted_feed": quoted_feed,
    "fact_load": fact_load,
    "reject_sink": reject_sink,
    "literal_products": literal_products,
    "corrected_history": corrected_history,
    "dimension_checks": dimension_checks,
    "stored_drilldown": stored_drilldown,
    "scanned_lines": scanned_lines,
    "median_prices": median_prices,
    "distinct_buyers": distinct_buyers,
}


def registered() -> dict[str, Query]:
    def in_plain_types(query: Query) -> Query:
        return lambda spark, sf_dir: plain(query(spark, sf_dir))
    return {name: in_plain_types(query) for name, query in QUERIES.items()}
