"""The benchmark tables seen as a star, as text feeds and as version histories.

Prescriptions are order lines (person = customer, territory = nation, product = part); contacts
are events (script = purchase, call = click, product = the number in ``props``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.dates import date_key, year_month
from starloom.operators.calendar import calendar_over, day_bounds
from starloom.operators.coerce import REASON
from starloom.operators.positions import with_keys
from starloom.operators.resolve import annotate_keys, version_segments
from starloom.operators.scd2 import apply_scd2
from starloom.session import pin

OWN_BRANDS_UP_TO = 10
OWN_PRODUCTS_BELOW = 50


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ------------------------------------------------------------ prescriptions star
def orders_by_person(spark: SparkSession, sf_dir: str, territory: bool) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("hcp_key"),
        F.col("o_orderdate").cast("date").alias("day"))
    if not territory:
        return orders
    # Joined to the orders, not to the lines: the lines are the larger side and move only once.
    people = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("hcp_key"), F.col("c_nationkey").alias("territory_key"))
    return orders.join(people, "hcp_key")


def prescriptions(spark: SparkSession, sf_dir: str, territory: bool = True) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.col("l_partkey").alias("product_key"),
        F.col("l_quantity").cast("int").alias("trx_count"),
        F.col("l_extendedprice").cast("decimal(14,2)").alias("gross_sales"))
    return (
        lines.join(orders_by_person(spark, sf_dir, territory), "o_orderkey")
        .withColumn("date_key", date_key(F.col("day")))
        .withColumn("year_month", year_month(F.col("day")))
        .drop("o_orderkey", "day")
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    brand_number = F.substring("p_brand", 7, 10).cast("int")
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_key"), F.col("p_brand").alias("brand_name"),
        F.col("p_type").alias("therapeutic_area"),
        (brand_number > OWN_BRANDS_UP_TO).alias("is_competitor"))


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("hcp_key"), F.col("c_custkey").alias("hcp_id"),
        F.col("c_name").alias("full_name"), F.col("c_mktsegment").alias("specialty"))


def territories(spark: SparkSession, sf_dir: str) -> DataFrame:
    regions = table(spark, sf_dir, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    return table(spark, sf_dir, "nation").join(regions, "n_regionkey").select(
        F.col("n_nationkey").alias("territory_key"),
        F.concat(F.lit("T-"), F.lpad(F.col("n_nationkey").cast("string"), 3, "0"))
        .alias("territory_code"),
        F.col("n_name").alias("territory_name"), F.col("r_name").alias("region"))


def rx_star(spark: SparkSession, sf_dir: str, territory: bool = True) -> dict[str, DataFrame]:
    return {
        "fact_prescriptions": prescriptions(spark, sf_dir, territory),
        "dim_product": products(spark, sf_dir),
        "dim_hcp": people(spark, sf_dir),
        "dim_territory": territories(spark, sf_dir),
    }


# ------------------------------------------------------------------ contact star
def contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", F.col("user_id").alias("hcp_id"), F.col("ts").cast("date").alias("day"),
        "event_type", "value",
        F.get_json_object("props", "$.k").cast("int").alias("product_code"))


def scripts_and_calls(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Purchases as scripts (trx = whole value), clicks as calls."""
    events = contacts(spark, sf_dir)
    scripts = events.where("event_type = 'purchase'").select(
        "hcp_id", "day", F.floor("value").alias("trx"))
    return scripts, events.where("event_type = 'click'").select("hcp_id", "day")


def contact_versions(events: DataFrame) -> DataFrame:
    """People start without a decile; each day's last signup may set one."""
    start = events.groupBy("hcp_id").agg(F.date_sub(F.min("day"), 1).alias("effective_date"))
    signup = events.where("event_type = 'signup'").groupBy("hcp_id", "day").agg(
        F.max_by("value", "event_id").alias("value"))
    feed = start.withColumn("decile", F.lit(None).cast("int")).unionByName(signup.select(
        "hcp_id", F.col("day").alias("effective_date"),
        (F.floor("value") % 10 + 1).cast("int").alias("decile")))
    versions = apply_scd2(None, feed.withColumn("territory_key", F.lit(0)))
    return with_keys(versions, ["hcp_id", "valid_from"], "hcp_key")


def contact_star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    events = pin(contacts(spark, sf_dir))  # parsed once for its five uses
    days = calendar_over(day_bounds(events.select("day")))
    codes = events.select("product_code").distinct().select(
        "product_code", F.col("product_code").alias("product_key"),
        (F.col("product_code") >= OWN_PRODUCTS_BELOW).alias("is_competitor"))
    versions = contact_versions(events)
    stretches = pin(version_segments(versions))

    def fact(event_type: str, *measures: str) -> DataFrame:
        rows = events.where(F.col("event_type") == event_type).select(
            "hcp_id", "day", "product_code", F.floor("value").alias("trx_count"))
        keyed = annotate_keys(rows, stretches, codes, days, "day")
        return keyed.where(F.col(REASON).isNull()).select(
            "date_key", "hcp_key", "product_key", "territory_key", *measures)

    return {"fact_prescriptions": fact("purchase", "trx_count"), "fact_sales_calls": fact("click"),
            "dim_product": codes, "dim_hcp": versions, "dim_date": days}


# ------------------------------------------------------------------- text feed
def _dirt(clean: Column, discount: int, by_tax: dict[int, str | None]) -> Column:
    """Replace the text on lines with this discount by one damaged form per tax rate."""
    hit = F.col("discount") == discount
    return reduce(lambda text, case: text.when(hit & (F.col("tax") == case[0]), F.lit(case[1])),
                  by_tax.items(), F).otherwise(clean)


def rx_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as an all-text prescription feed; some rates mark damaged lines."""
    percent = lambda c: F.floor(F.col(c) * 100 + 0.5)
    lines = table(spark, sf_dir, "lineitem").select(
        "*", percent("l_discount").alias("discount"), percent("l_tax").alias("tax"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    whole = F.col("l_quantity").cast("int")
    text = lambda c: c.cast("string")
    # Orders grow with the lines, so they are never worth broadcasting; and the shuffle spreads the
    # parsing that follows even when the lines come in a single row group.
    return lines.join(orders.hint("merge"), lines.l_orderkey == orders.o_orderkey).select(
        _dirt(F.date_format(F.col("l_shipdate"), "yyyy-MM-dd"), 8, {
            8: "2024-02-30", 7: "1998-3-7", 6: "1998", 5: None, 4: "1998-05-01T10:00",
        }).alias("rx_date"),
        _dirt(text(F.col("o_custkey")), 7, {7: "GHOST", 6: None}).alias("hcp_id"),
        _dirt(text(F.col("l_partkey")), 7, {8: "UNKNOWN-99"}).alias("product_code"),
        _dirt(text(whole), 10, {
            8: "N/A", 7: "", 6: "3.7", 5: "-1", 4: "2147483648", 3: " +4 ", 2: "1e1", 1: "7.0",
            0: "inf",
        }).alias("trx_count"),
        text(F.floor(whole / 3)).alias("nrx_count"),
        _dirt(text(F.col("l_quantity").cast("decimal(12,2)")), 9, {
            8: "n.a.", 7: None, 6: "1.005", 5: "99999999999.99", 4: "0x10", 3: "1_000", 2: "1d",
            1: " ",
        }).alias("units"),
        text(F.col("l_extendedprice").cast("decimal(14,2)")).alias("gross_sales"),
    )


def call_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as an all-text call feed; purchases and errors are no valid kind of call."""
    kinds = F.create_map(*[F.lit(x) for x in (
        "click", "DETAIL", "view", "SAMPLE", "signup", "FOLLOW_UP", "purchase", "PURCHASE")])
    return contacts(spark, sf_dir).select(
        F.date_format("day", "yyyy-MM-dd").alias("call_date"),
        F.col("hcp_id").cast("string").alias("hcp_id"),
        F.col("product_code").cast("string").alias("product_code"),
        F.try_element_at(kinds, "event_type").alias("call_type"),
        F.floor("value").cast("string").alias("duration_minutes"),
        F.lit("0").alias("samples_dropped"))


def hcp_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as an all-text prescriber feed; ``ordinal`` is a row's place in it.

    The priority gives the decile; one priority has none. Customers of one nation lack a territory.
    """
    decile = (
        F.when(F.col("priority") == "1-URGENT", "9").when(F.col("priority") == "2-HIGH", "7")
        .when(F.col("priority") == "3-MEDIUM", "5.0").when(F.col("priority") == "5-LOW", " 1")
        .otherwise("N/A"))
    code = F.when(F.col("c_nationkey") > 0, F.format_string("T-%03d", "c_nationkey"))
    people = table(spark, sf_dir, "customer")
    return order_changes(spark, sf_dir).join(people, F.col("hcp_id") == F.col("c_custkey")).select(
        F.format_string("HCP-%010d", "hcp_id").alias("hcp_id"),
        F.col("c_name").alias("full_name"), F.col("c_mktsegment").alias("specialty"),
        decile.alias("decile"), code.alias("territory_code"),
        F.col("effective_date").cast("string").alias("effective_date"), "ordinal")


# ------------------------------------------------------------ version histories
def order_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a change feed: each may change the customer's priority and status."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("hcp_id"), F.col("o_orderdate").cast("date").alias("effective_date"),
        F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status"),
        F.col("o_orderkey").alias("ordinal"))


def order_windows(spark: SparkSession, sf_dir: str, days: int = 200) -> DataFrame:
    """Each order as a version valid for ``days`` days: a history with gaps and overlaps."""
    people = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("territory_key"))
    return table(spark, sf_dir, "orders").join(people, "o_custkey").select(
        F.col("o_orderkey").alias("hcp_key"), F.col("o_custkey").cast("string").alias("hcp_id"),
        "territory_key",
        F.col("o_orderdate").cast("date").alias("valid_from"),
        F.date_add(F.col("o_orderdate").cast("date"), days - 1).alias("valid_to"),
        (F.col("o_orderstatus") == "O").alias("is_current"))


def order_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date"))
    return calendar_over(day_bounds(days))


def product_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("product_code"),
        F.col("p_partkey").alias("product_key"))
