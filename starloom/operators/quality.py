"""Checks over the star. Each is a frame of (check, violations); all must be 0 to publish."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators.resolve import version_marks
from starloom.schemas import CALL_TYPES, FACT_KEYS, LEAST_SPREAD, NOT_NULL, UNIQUE

PRIME, DIGESTS = 2 ** 31 - 1, 2
PERIODS, BUCKETS = 256, 64


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def scalars(df: DataFrame, values: Mapping[str, Column], name: str = "check",
            value: str = "violations") -> DataFrame:
    """Several aggregates of one pass, one row each."""
    one_row = df.agg(*[v.cast("bigint").alias(k) for k, v in values.items()])
    return one_row.unpivot([], [f"`{k}`" for k in values], name, value)


def count_rows_where(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """Rows that meet each condition, in one pass (a null condition does not count)."""
    return scalars(df, {k: F.count_if(F.coalesce(c, F.lit(False)))
                        for k, c in conditions.items()})


def nulls(table: str, columns: Sequence[str]) -> dict[str, Column]:
    return {f"{table}.{c} is null": F.col(c).isNull() for c in columns}


def row_conditions(table: str) -> dict[str, Column]:
    """Conditions that no row of a warehouse table may meet."""
    found = nulls(table, NOT_NULL[table])
    if table == "fact_prescriptions":
        measures = ("trx_count", "nrx_count", "units", "gross_sales")
        found["fact_prescriptions has a negative measure"] = reduce(
            lambda a, b: a | b, [F.col(c) < 0 for c in measures])
        found["fact_prescriptions has nrx above trx"] = F.col("nrx_count") > F.col("trx_count")
    if table == "fact_sales_calls":
        found["fact_sales_calls has an unlisted call_type"] = ~F.col("call_type").isin(*CALL_TYPES)
    if table == "dim_hcp":
        found["dim_hcp has a decile outside 1..10"] = ~F.col("decile").between(1, 10)
        found["dim_hcp has an inverted window"] = F.col("valid_from") > F.col("valid_to")
    return found


def _per_check(df: DataFrame, violations: Column) -> DataFrame:
    return df.groupBy("check").agg(F.sum(violations).cast("bigint").alias("violations"))


def duplicates(label: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Values of a composite key that occur more than once."""
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return scalars(repeated, {label: F.count_if(F.col("_n") > 1)})


def repeated_keys(tables: Mapping[str, DataFrame],
                  keys: Mapping[str, Sequence[str]]) -> DataFrame:
    """Repeated values of single-column keys, over all tables in one aggregation."""
    values = stack([
        tables[t].select(F.lit(f"{t}.{k} is repeated").alias("check"),
                         F.col(k).cast("string").alias("value"))
        for t, of_table in keys.items() for k in of_table
    ])
    counted = values.groupBy("check", "value").agg(F.count(F.lit(1)).alias("_n"))
    return _per_check(counted, (F.col("_n") > 1).cast("int"))


def orphans(rows: Mapping[str, DataFrame], dims: Mapping[str, DataFrame],
            keys: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rows whose key is missing from its dimension, for all tables and keys in one pass.

    ``dims`` holds the dimension of each key column. The keys are unpivoted and counted per value
    before they meet the dimensions, so a hot key travels as one row per task.
    """
    def unpivoted(table: str) -> DataFrame:
        columns = [F.col(k).cast("bigint").alias(k) for k in keys[table]]
        return rows[table].select(*columns).unpivot([], list(keys[table]), "key", "value").select(
            F.concat(F.lit(f"{table}."), F.col("key"), F.lit(" has no dimension row"))
            .alias("check"), "key", "value")

    counted = stack([unpivoted(t) for t in keys]).groupBy("check", "key", "value").agg(
        F.count(F.lit(1)).alias("n"))
    known = stack([
        dim.select(F.lit(k).alias("known_key"), F.col(k).cast("bigint").alias("known_value"))
        for k, dim in dims.items()
    ]).distinct()
    matched = counted.join(known, (F.col("key") == F.col("known_key"))
                           & (F.col("value") == F.col("known_value")), "left")
    return _per_check(matched, F.when(F.col("known_key").isNull(), F.col("n")).otherwise(0))


def not_one_current(dim: DataFrame, business_key: str = "hcp_id") -> DataFrame:
    current = dim.groupBy(business_key).agg(F.count_if(F.col("is_current")).alias("_n"))
    return scalars(current, {"people without exactly one current version":
                             F.count_if(F.col("_n") != 1)})


def overlapping_versions(dim: DataFrame, business_key: str = "hcp_id") -> DataFrame:
    """Pairs of versions of one person that share a day, counted without forming the pairs.

    Going through a person's days, every version that starts pairs with those still running and
    with those starting the same day. Inverted windows are reported by their own check.
    """
    earlier = (
        Window.partitionBy(business_key).orderBy("mark_day")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before = F.coalesce(F.sum(F.col("starts") - F.col("ends")).over(earlier), F.lit(0))
    marks = version_marks(dim, business_key).withColumn("running", before - F.col("ends"))
    s = F.col("starts")
    pairs = s * F.col("running") + F.floor(s * (s - 1) / 2)
    return scalars(marks, {"pairs of overlapping versions": F.coalesce(F.sum(pairs), F.lit(0))})


def facts_outside_version(facts: Mapping[str, DataFrame], dim_hcp: DataFrame,
                          dim_date: DataFrame) -> DataFrame:
    """Facts dated outside the window of the version they point to.

    Facts are not counted per (version, day) first: nearly every one is a group of its own, and a task
    would hold them all. Skew handling of the join splits the facts of a hot version.
    """
    kinds = list(facts)  # facts carry their table's place here, not the text of their check
    dated = (
        stack([facts[name].select(F.lit(k).alias("kind"), "hcp_key", "date_key")
               for k, name in enumerate(kinds)])
        .join(dim_date.select("date_key", "full_date"), "date_key")
        .join(dim_hcp.select("hcp_key", "valid_from", "valid_to"), "hcp_key")
    )
    inside = F.col("full_date").between(F.col("valid_from"), F.col("valid_to"))
    names = F.array(*[F.lit(f"{name} rows outside their version's window") for name in kinds])
    counted = dated.groupBy("kind").agg(
        F.sum(F.when(inside, 0).otherwise(1)).cast("bigint").alias("violations"))
    return counted.select(F.get(names, F.col("kind")).alias("check"), "violations")


def _whole(measure: Column, kind: T.DataType) -> Column:
    """A measure as a long: decimals in units of their last place."""
    if isinstance(kind, T.DecimalType) and kind.scale:
        return F.rint(measure.cast("double") * float(10 ** kind.scale)).cast("long")
    return measure.cast("long")


def _digests(df: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> list[Column]:
    """Two numbers per row whose sums over rows tell totals per key apart.

    Each is the row's count and measures weighted by hashes of its key's hash, modulo a prime. Sums do not
    depend on the order of rows, and rows of one key add up like their measures do, so equal totals
    give equal sums. Different ones give equal sums with a chance of some 2 ** -62.
    """
    key = F.xxhash64(*keys)
    values = [F.lit(1).cast("long"), *[_whole(F.col(m), df.schema[m].dataType) for m in measures]]
    out = []
    for digest in range(DIGESTS):
        terms = [
            F.pmod(F.coalesce(v, F.lit(0)), F.lit(PRIME))
            * F.pmod(F.xxhash64(F.lit(digest * 100 + k), key), F.lit(PRIME)) % PRIME
            for k, v in enumerate(values)]
        out.append(reduce(lambda a, b: a + b, terms) % PRIME)
    return out


def differing_buckets(left: DataFrame, right: DataFrame, keys: Sequence[str],
                      measures: Sequence[str]) -> DataFrame:
    """(period, bucket) groups of key values in which two frames hold different totals per key.

    The month of a key's days and a hash of its other parts choose the group, so there are at most
    ``PERIODS * BUCKETS`` of them however many rows there are.
    """
    def summed(df: DataFrame, sign: int) -> DataFrame:
        return df.select(*branch(df, keys), F.lit(sign).alias("rows"), *[
            (d * sign).alias(f"digest_{k}") for k, d in enumerate(_digests(df, keys, measures))])

    sums = ["rows", *[f"digest_{k}" for k in range(DIGESTS)]]
    found = summed(left, 1).unionByName(summed(right, -1)).groupBy("period", "bucket").agg(
        *[F.sum(c).alias(c) for c in sums])
    apart = [F.col("rows") != 0, *[F.col(c) % PRIME != 0 for c in sums[1:]]]
    return found.where(reduce(lambda a, b: a | b, apart)).select("period", "bucket")


def branch(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    """Group of a key: the month of its days and a hash of the rest (of all if there is no rest)."""
    days = [k for k in keys if isinstance(df.schema[k].dataType, T.DateType)]
    rest = [k for k in keys if k not in days] or list(keys)
    month = F.xxhash64(F.lit(0), *[F.trunc(F.col(k), "month") for k in days])
    return [F.pmod(month, F.lit(PERIODS)).alias("period"),
            F.pmod(F.xxhash64(*rest), F.lit(BUCKETS)).alias("bucket")]


def differing_totals(left: DataFrame, right: DataFrame, keys: Sequence[str],
                     measures: Sequence[str]) -> DataFrame:
    """Key groups whose rows or sums differ between two frames, with left minus right.

    Digests are compared first, a row per group of keys; only rows of groups that differ are then
    added up per key, so two frames that agree shuffle next to nothing. One aggregation over the
    signed union takes the place of a full outer join of two.
    """
    # At most PERIODS * BUCKETS rows, so the broadcast is bounded.
    damaged = F.broadcast(differing_buckets(left, right, keys, measures))

    def signed(df: DataFrame, sign: int) -> DataFrame:
        rows = df.select("*", *branch(df, keys)).join(damaged, ["period", "bucket"], "left_semi")
        # Negated, not multiplied: a product of decimals is wider, and every row would carry it.
        return rows.select(*keys, F.lit(sign).alias("rows_diff"), *[
            (F.col(m) if sign > 0 else -F.col(m)).alias(f"{m}_diff") for m in measures])

    columns = ["rows_diff", *[f"{m}_diff" for m in measures]]
    totals = signed(left, 1).unionByName(signed(right, -1)).groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in columns])
    return totals.where(reduce(lambda a, b: a | b, [F.col(c) != 0 for c in columns]))


def distribution(dim_hcp: DataFrame, dim_date: DataFrame) -> DataFrame:
    """(measure, value, enough): spread of deciles and months, and whether history exists."""
    people = scalars(dim_hcp, {
        "distinct_deciles": F.count_distinct("decile"),
        "closed_versions": F.count_if(~F.col("is_current"))}, "measure", "value")
    months = scalars(dim_date, {"distinct_months": F.count_distinct("year_month")},
                     "measure", "value")
    least = F.create_map(*[F.lit(x) for pair in LEAST_SPREAD.items() for x in pair])
    return people.unionByName(months).withColumn(
        "enough", F.col("value") >= F.element_at(least, F.col("measure")))


def warehouse_checks(star: Mapping[str, DataFrame]) -> DataFrame:
    """Every check of the publish gate."""
    frames = [count_rows_where(star[t], row_conditions(t)) for t in NOT_NULL]
    facts = {t: star[t] for t in ("fact_prescriptions", "fact_sales_calls")}
    frames += [
        repeated_keys(star, UNIQUE),
        duplicates("fact_prescriptions grain is repeated", star["fact_prescriptions"],
                   ["hcp_key", "product_key", "date_key"]),
        orphans(star, {k: star[d] for k, d in FACT_KEYS.items()},
                {**{t: tuple(FACT_KEYS) for t in facts}, "dim_hcp": ("territory_key",)}),
        facts_outside_version(facts, star["dim_hcp"], star["dim_date"]),
        not_one_current(star["dim_hcp"]),
        overlapping_versions(star["dim_hcp"]),
    ]
    return stack(frames)


def failed(checks: DataFrame) -> list[tuple[str, int]]:
    """The failed checks; at most one row per check comes to the driver."""
    rows = checks.where("violations <> 0").orderBy("check").collect()
    return [(r["check"], r["violations"]) for r in rows]
