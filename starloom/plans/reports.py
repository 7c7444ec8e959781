"""The four reports and the two query shapes over the star.

A star is a dict of DataFrames named as in ``schemas.NOT_NULL``. Facts are aggregated before they
meet anything but the small product table, so the joins that follow see one row per group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.functions.dates import year_month
from starloom.functions.numbers import ntile_of, percent, ratio, whole
from starloom.operators.exposure import add_up, script_and_call_marks, with_prior_calls
from starloom.operators.positions import with_ranks
from starloom.operators.selection import distinct_ids, medians
from starloom.schemas import BASELINE_MONTHS, DRILLDOWN_HCP_KEY, GROWTH_ASK, WATCH_FLOOR
from starloom.session import pin
from starloom.sources.tables import Run

Star = dict[str, DataFrame]
VOLUME_BITS = 44


def _with_days(fact: DataFrame, star: Star, *columns: str) -> DataFrame:
    """Calendar columns on the fact; those the stored layout already carries need no join."""
    wanted = [c for c in columns if c not in fact.columns]
    if not wanted:
        return fact
    return fact.join(star["dim_date"].select("date_key", *wanted), "date_key")


def _own_brand(fact: DataFrame, star: Star) -> DataFrame:
    own = star["dim_product"].where(~F.col("is_competitor")).select("product_key")
    return fact.join(own, "product_key")


def brand_share_mom(star: Star) -> DataFrame:
    """Share of each brand in its therapeutic market by month, and the change in points."""
    products = star["dim_product"].select("product_key", "brand_name", "therapeutic_area")
    monthly = (
        _with_days(star["fact_prescriptions"], star, "year_month")
        .join(products, "product_key")
        .groupBy("year_month", "therapeutic_area", "brand_name")
        .agg(F.sum("trx_count").alias("trx"))
    )
    market = Window.partitionBy("year_month", "therapeutic_area")
    brand = Window.partitionBy("therapeutic_area", "brand_name").orderBy("year_month")
    return (
        monthly.withColumn("share_pct", percent(F.col("trx"), F.sum("trx").over(market), 2))
        .withColumn("share_delta_pp", F.col("share_pct") - F.lag("share_pct").over(brand))
        .select("year_month", "brand_name", "trx", "share_pct", "share_delta_pp",
                "therapeutic_area")
        .orderBy("year_month", "therapeutic_area", F.col("share_pct").desc_nulls_first(),
                 "brand_name")
    )


def prescriber_ranking(star: Star) -> DataFrame:
    """Own-brand volume per prescriber version: decile and rank inside the territory."""
    volume = (
        _own_brand(star["fact_prescriptions"], star)
        .groupBy("hcp_key", "territory_key")
        .agg(F.sum("trx_count").alias("total_trx"))
    )
    ranked = with_ranks(volume, "territory_key", "total_trx", ["hcp_key"])
    people = star["dim_hcp"].select("hcp_key", "hcp_id", "full_name", "specialty")
    places = star["dim_territory"].select("territory_key", "territory_name")
    return (
        ranked.join(people, "hcp_key").join(places, "territory_key")
        .select(
            "hcp_id", "full_name", "specialty", "territory_name", "total_trx",
            ntile_of(F.col("position"), F.col("group_rows"), 10).alias("calculated_decile"),
            F.col("value_rank").alias("territory_rank"),
        )
        .orderBy("territory_name", "territory_rank")
    )


def territory_attainment(star: Star) -> DataFrame:
    """Monthly volume of each territory against a quota from its own first months."""
    monthly = (
        _with_days(_own_brand(star["fact_prescriptions"], star), star, "year_month")
        .groupBy("territory_key", "year_month")
        .agg(F.sum("trx_count").alias("actual_trx"))
        .withColumn("year", F.substring("year_month", 1, 4))
    )
    in_order = Window.partitionBy("territory_key").orderBy("year_month")
    territory = Window.partitionBy("territory_key")
    in_baseline = F.col("month_seq") <= BASELINE_MONTHS
    planned = (
        monthly.withColumn("month_seq", F.row_number().over(in_order))
        .withColumn("_base_trx", F.sum(F.when(in_baseline, F.col("actual_trx"))).over(territory))
        .withColumn("_base_months", F.count(F.when(in_baseline, 1)).over(territory))
        .withColumn("target_trx", F.round(
            ratio(F.col("_base_trx"), F.col("_base_months"), GROWTH_ASK), 0).cast("bigint"))
    )
    to_date = (
        Window.partitionBy("territory_key", "year").orderBy("year_month")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    actual, target = F.col("actual_trx"), F.col("target_trx")
    attained = ratio(actual, target)
    month = Window.partitionBy("year_month").orderBy(attained.desc_nulls_first())
    places = star["dim_territory"].select(
        "territory_key", "territory_code", "territory_name", "region")
    return (
        planned.withColumn("ytd_actual_trx", F.sum("actual_trx").over(to_date))
        .withColumn("ytd_target_trx", F.sum("target_trx").over(to_date))
        .withColumn("attainment_rank_in_month", F.rank().over(month))
        .join(places, "territory_key")
        .select(
            "territory_code", "territory_name", "region", "year_month", "actual_trx", "target_trx",
            (actual - target).alias("gap_to_target_trx"),
            percent(actual, target, 1).alias("attainment_pct"),
            "ytd_actual_trx", "ytd_target_trx",
            percent(F.col("ytd_actual_trx"), F.col("ytd_target_trx"), 1)
            .alias("ytd_attainment_pct"),
            "attainment_rank_in_month",
            F.when(in_baseline, F.lit("BASELINE PERIOD"))
            .when(actual >= target, F.lit("AT/ABOVE PLAN"))
            .when(whole(actual) >= F.lit(WATCH_FLOOR).cast("decimal(3,2)") * whole(target),
                  F.lit("WATCH"))
            .otherwise(F.lit("BEHIND PLAN")).alias("plan_status"),
        )
        .orderBy("year_month", F.col("attainment_pct").asc_nulls_last(), "territory_code")
    )


def label_as_of(facts: DataFrame, dim_hcp: DataFrame, day: str, *attributes: str) -> DataFrame:
    """Attributes of the person's version valid on ``day``; rows without a version fall out."""
    versions = dim_hcp.select(
        F.col("hcp_id").alias("_hcp_id"), "valid_from", "valid_to", *attributes)
    return facts.join(
        versions, (F.col("hcp_id") == F.col("_hcp_id"))
        & F.col(day).between(F.col("valid_from"), F.col("valid_to"))
    ).drop("_hcp_id", "valid_from", "valid_to")


def own_person_days(star: Star) -> DataFrame:
    """Own-brand scripts and calls per person and day, added up per version-day before the joins.

    Any own-brand call counts for any own-brand script, and versions of a person count as one.
    """
    keys = ("hcp_key", "date_key", "product_key")
    scripts = star["fact_prescriptions"].withColumnRenamed("trx_count", "trx")
    marks = script_and_call_marks(scripts, star["fact_sales_calls"], *keys)
    version_days = add_up(_own_brand(marks, star), "hcp_key", "date_key")
    dated = (
        version_days.join(star["dim_hcp"].select("hcp_key", "hcp_id"), "hcp_key")
        .join(star["dim_date"].select("date_key", F.col("full_date").alias("day")), "date_key")
    )
    return add_up(dated, "hcp_id", "day")


def person_months(star: Star, *attributes: str) -> DataFrame:
    """One row per person and month with scripts: volume, exposure, cohort, and ``attributes`` of the
    version as of the month's last day with scripts."""
    exposed = F.col("prior_calls") > 0
    months = (
        with_prior_calls(own_person_days(star))
        .withColumn("year_month", year_month(F.col("day")))
        .groupBy("hcp_id", "year_month")
        .agg(
            F.max("day").alias("last_rx_day"),
            F.sum("trx").alias("trx_in_month"),
            F.count(F.lit(1)).alias("rx_days"),
            F.count_if(exposed).alias("exposed_days"),
            F.bool_or(exposed).alias("was_called"),
        )
        .withColumn("cohort", F.when(F.col("was_called"), F.lit("CALLED"))
                    .otherwise(F.lit("NOT CALLED")))
    )
    return label_as_of(months, star["dim_hcp"], "last_rx_day", *attributes)


def _numbered(dim_hcp: DataFrame) -> DataFrame:
    """Versions with ``person``, a dense number that all versions of a person share."""
    return dim_hcp.withColumn("person", F.min("hcp_key").over(Window.partitionBy("hcp_id")))


def call_effectiveness(star: Star) -> DataFrame:
    """Prescribing of called and uncalled person-months, nationally and per decile.

    The person-months are written down once. People are counted by merging bitmaps, all else from
    one row per (decile, cohort, volume): sums by grouping sets, medians by selection.
    """
    months = pin(
        person_months({**star, "dim_hcp": _numbered(star["dim_hcp"])}, "decile", "person")
        .withColumn("_exposed_pct", percent(F.col("exposed_days"), F.col("rx_days"), 12)))
    volumes = months.groupBy("decile", "cohort", "trx_in_month").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("_exposed_pct").cast("decimal(20,12)")).alias("exposed_pct"),
    )
    in_strata = volumes.select("cohort", "trx_in_month", "n", F.inline(F.array(
        F.struct(F.lit(1).alias("national"), F.lit(None).cast(
            volumes.schema["decile"].dataType).alias("in_decile")),
        F.struct(F.lit(0).alias("national"), F.col("decile").alias("in_decile")))))
    middle = medians(in_strata, ["national", "in_decile", "cohort"], "trx_in_month", "n",
                     VOLUME_BITS).select(
        "national", "in_decile", F.col("cohort").alias("in_cohort"),
        ((F.col("low") + F.col("high")) / F.lit(2)).alias("_median"))
    people = distinct_ids(months, "person", [["cohort"], ["decile", "cohort"]]).select(
        (1 - F.col("set_id")).alias("national"), F.col("decile").alias("in_decile"),
        F.col("cohort").alias("in_cohort"), F.col("ids").alias("hcps"))
    figures = middle.join(people, (middle["national"] == people["national"])
                          & middle["in_decile"].eqNullSafe(people["in_decile"])
                          & (middle["in_cohort"] == people["in_cohort"])).select(
        middle["*"], "hcps")
    sums = volumes.groupingSets(
        [[F.col("cohort")], [F.col("decile"), F.col("cohort")]], F.col("decile"), F.col("cohort")
    ).agg(
        F.grouping("decile").cast("int").alias("is_national_row"),
        F.sum("n").alias("hcp_months"),
        F.sum(F.col("trx_in_month") * F.col("n")).alias("total_trx"),
        F.sum(F.col("exposed_pct").cast("decimal(20,12)")).alias("_exposed_pct"),
    )
    strata = sums.join(
        figures, (F.col("is_national_row") == F.col("national"))
        & F.col("decile").eqNullSafe(F.col("in_decile")) & (F.col("cohort") == F.col("in_cohort"))
    ).select(
        F.when(F.col("is_national_row") == 1, F.lit("ALL DECILES"))
        .when(F.col("decile").isNull(), F.lit("DECILE UNKNOWN"))
        .otherwise(F.concat(F.lit("DECILE "), F.lpad(F.col("decile").cast("string"), 2, "0")))
        .alias("stratum"),
        "is_national_row", "cohort", "hcps", "hcp_months", "total_trx",
        F.round(ratio(F.col("total_trx"), F.col("hcp_months")), 2).alias("avg_trx_per_hcp_month"),
        F.round(F.col("_median").cast("decimal(20,4)"), 2).alias("median_trx_per_hcp_month"),
        F.round(F.col("_exposed_pct") / F.col("hcp_months").cast("decimal(12,0)"), 1)
        .alias("pct_of_rx_days_exposed"),
    )
    average = F.col("avg_trx_per_hcp_month").cast("decimal(20,2)")
    uncalled = F.max(F.when(F.col("cohort") == "NOT CALLED", average)).over(
        Window.partitionBy("stratum"))
    lift_pct = average * F.lit("100").cast("decimal(3,0)") / F.nullif(
        uncalled, F.lit(0).cast("decimal(20,2)")) - F.lit(100)
    return (
        strata.withColumn("trx_lift_vs_uncalled", F.round(average - uncalled, 2))
        .withColumn("lift_pct", F.round(lift_pct, 1))
        .orderBy(F.desc("is_national_row"), "stratum", "cohort")
        .select(
            "stratum", "cohort", "hcps", "hcp_months", "total_trx", "avg_trx_per_hcp_month",
            "median_trx_per_hcp_month", "pct_of_rx_days_exposed", "trx_lift_vs_uncalled",
            "lift_pct")
    )


def monthly_brand_rollup(star: Star) -> DataFrame:
    products = star["dim_product"].select("product_key", "brand_name")
    return (
        _with_days(star["fact_prescriptions"], star, "year_month").join(products, "product_key")
        .groupBy("year_month", "brand_name").agg(F.sum("trx_count").alias("trx"))
    )


def prescriber_drilldown(star: Star, hcp_key: int = DRILLDOWN_HCP_KEY) -> DataFrame:
    one = star["fact_prescriptions"].where(F.col("hcp_key") == hcp_key)
    return (
        _with_days(one, star, "year_month").groupBy("year_month")
        .agg(F.sum("trx_count").alias("trx"))
    )


def stored_drilldown(run: Run, hcp_key: int = DRILLDOWN_HCP_KEY) -> DataFrame:
    """``prescriber_drilldown`` of a published run, by the access path beside the facts."""
    return run.prescriber(hcp_key).groupBy("year_month").agg(F.sum("trx").alias("trx"))


REPORTS = {
    "brand_share_mom": brand_share_mom,
    "prescriber_ranking": prescriber_ranking,
    "territory_attainment": territory_attainment,
    "call_effectiveness": call_effectiveness,
    "monthly_brand_rollup": monthly_brand_rollup,
    "prescriber_drilldown": prescriber_drilldown,
}
