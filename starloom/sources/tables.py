"""Parquet tables, run folders and publication."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.schemas import NOT_NULL

LOADED, REJECTED = "loaded", "rejected"
OUTCOME = "outcome"
NO_MONTH = "none"
HCP_ROWS = "hcp_rows"
BY_PRESCRIBER = "rx_by_prescriber"
KEYS_PER_SLICE = 16_384
ROWS_PER_SLICE = 10_000_000


def write_table(df: DataFrame, path: str, columns: Sequence[str] | None = None,
                mode: str = "overwrite") -> None:
    (df.select(*columns) if columns else df).write.mode(mode).parquet(path)


def append_rows(df: DataFrame, path: str, columns: Sequence[str]) -> int:
    """Append the given columns, in order; returns the number of rows appended."""
    spark = df.sparkSession
    before = row_count(spark, path) if _exists(spark, path) else 0
    write_table(df, path, columns, mode="append")
    return row_count(spark, path) - before


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path)
        return True
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return False


def row_count(spark: SparkSession, path: str) -> int:
    """Counted on the written files (footers only), so retried tasks cannot count twice."""
    return spark.read.parquet(path).count()


def slices_per_month(rows: int, months: int) -> int:
    """How many prescriber slices keep a month's files at some ten million rows each."""
    return max(1, round(rows / max(months, 1) / ROWS_PER_SLICE))


def cluster_fact(fact: DataFrame, highest_key: int, months: int, slices: int,
                 extra: Sequence[str] = ()) -> DataFrame:
    """Rows gathered by month and prescriber slice and sorted by prescriber inside each file.

    Prescriber keys are dense, so slices of equal key width hold equally many prescribers.
    Rebalancing lets Spark split oversized (month, slice) groups by measured size and merge small
    ones; about one partition per group keeps a month from being scattered over many files. The
    sort gives Parquet narrow min/max ranges for the prescriber drill-down.
    """
    groups = [*extra, "year_month"]
    slice_no = F.floor((F.col("hcp_key") - 1) * slices / F.lit(max(highest_key, 1)))
    return (
        fact.withColumn("_slice", slice_no.cast("int"))
        .hint("rebalance", months * slices + 1, *groups, "_slice").drop("_slice")
        .sortWithinPartitions(*groups, "hcp_key", "date_key")
    )


def write_outcome(annotated: DataFrame, path: str, partitions: Sequence[str]) -> None:
    """Loaded and rejected rows of one pass, side by side in one partitioned table.

    A partitioned table without rows has no file to tell its columns, so they are kept beside it.
    """
    annotated.write.mode("overwrite").partitionBy(*partitions).parquet(path)
    write_table(annotated.sparkSession.createDataFrame([], annotated.schema), f"{path}.schema")


def _stored(spark: SparkSession, path: str) -> DataFrame:
    if not _exists(spark, f"{path}.schema"):
        return spark.read.parquet(path)
    return spark.read.schema(spark.read.parquet(f"{path}.schema").schema).parquet(path)


def read_outcome(spark: SparkSession, path: str, outcome: str) -> DataFrame:
    return _stored(spark, path).where(F.col(OUTCOME) == outcome).drop(OUTCOME)


def outcome_counts(spark: SparkSession, path: str) -> dict[str, int]:
    rows = _stored(spark, path).groupBy(OUTCOME).count().collect()
    counts = {r[OUTCOME]: r["count"] for r in rows}
    return {LOADED: counts.get(LOADED, 0), REJECTED: counts.get(REJECTED, 0)}


def write_by_prescriber(facts: DataFrame, folder: str) -> None:
    """An access path beside the facts: volume per prescriber version and month, by key.

    Slices of equal key width are folders, so a reader names the one folder it needs instead of
    listing them; a slice has at most ``KEYS_PER_SLICE`` rows a month. Inside, rows are sorted by
    key, which lets Parquet skip all pages but those of the key.
    """
    rolled = facts.groupBy("hcp_key", "year_month").agg(F.sum("trx_count").alias("trx"))
    (rolled.withColumn("slice", F.expr(f"(hcp_key - 1) div {KEYS_PER_SLICE}"))
     .hint("rebalance", "slice").sortWithinPartitions("slice", "hcp_key", "year_month")
     .write.mode("overwrite").partitionBy("slice").parquet(folder))


def read_prescriber(spark: SparkSession, folder: str, hcp_key: int) -> DataFrame:
    """(hcp_key, year_month, trx) of one prescriber version, from the one folder that can hold it."""
    path = f"{folder}/slice={(hcp_key - 1) // KEYS_PER_SLICE}"
    schema = "hcp_key long, year_month string, trx long"
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).where(F.col("hcp_key") == hcp_key)


class Warehouse:
    """A folder of runs and a log of published versions. Readers only ever see published ones.

    A version is a manifest: which folder holds each table, and for facts each month. So a version
    can take over months of the one before without copying them. Versions are numbered; the highest
    one is current. A version's manifest is one file, whose commit makes the version visible.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    @property
    def _log(self) -> str:
        return f"{self.root}/published"

    def new_run(self) -> Run:
        return Run(self.spark, f"{self.root}/runs/{uuid.uuid4().hex}")

    def publish(self, run: Run, batch: str | None = None) -> int:
        """Make ``run`` the current version; ``batch`` names the input that led to it."""
        version = (self._latest() or 0) + 1
        manifest = self.spark.createDataFrame(
            [(run.path, batch, *entry) for entry in run.manifest()],
            "run string, batch string, table string, year_month string, folder string")
        # Fails if the number is taken: of two runs from the same version one must start over.
        manifest.coalesce(1).write.mode("errorifexists").parquet(
            f"{self._log}/version={version:09d}")
        return version

    def _latest(self) -> int | None:
        if not _exists(self.spark, self._log):
            return None
        return self.spark.read.parquet(self._log).agg(F.max("version")).first()[0]

    def current(self) -> Run:
        return self.latest()[1]

    def latest(self) -> tuple[int, Run]:
        """The number of the current version and its run."""
        number = self._latest()
        if number is None:
            raise LookupError("nothing has been published yet")
        return number, self.version(number)

    def version(self, number: int) -> Run:
        """A published version, current or earlier. Its manifest has a row per table and month."""
        rows = self.spark.read.parquet(self._log).where(F.col("version") == number).collect()
        if not rows:
            raise LookupError(f"version {number} was not published")
        path = rows[0]["run"]
        own = all(r["folder"].startswith(f"{path}/") and r["year_month"] is None for r in rows)
        return Run(self.spark, path, None if own else [
            (r["table"], r["year_month"], r["folder"]) for r in rows])

    def holds(self, batch: str) -> bool:
        """Whether a version from ``batch`` was published."""
        return _exists(self.spark, self._log) and not self.spark.read.parquet(self._log).where(
            F.col("batch") == batch).isEmpty()


class Run:
    """One refresh: staging, dimensions, facts with their rejects.

    ``entries`` (table, month or None for all, folder) name what the run takes over from earlier
    ones; a run without entries holds all its tables itself.
    """

    def __init__(self, spark: SparkSession, path: str,
                 entries: Sequence[tuple[str, str | None, str]] | None = None):
        self.spark, self.path, self.entries = spark, path, entries

    def staging(self, feed: str) -> str:
        return f"{self.path}/staging/{feed}"

    def table(self, name: str) -> str:
        return f"{self.path}/warehouse/{name}"

    def manifest(self) -> list[tuple[str, str | None, str]]:
        if self.entries is not None:
            return list(self.entries)
        return [(name, None, self.table(name)) for name in (*NOT_NULL, HCP_ROWS, BY_PRESCRIBER)]

    def rows(self, name: str, outcome: str) -> DataFrame:
        """Loaded or rejected rows of a table, from every folder that holds some of them."""
        if self.entries is None:
            return read_outcome(self.spark, self.table(name), outcome)
        return self._over_folders(name, lambda folder: read_outcome(self.spark, folder, outcome))

    def prescriber(self, hcp_key: int) -> DataFrame:
        """(hcp_key, year_month, trx) of one prescriber version, by the access path."""
        if self.entries is None:
            return read_prescriber(self.spark, self.table(BY_PRESCRIBER), hcp_key)
        return self._over_folders(
            BY_PRESCRIBER, lambda folder: read_prescriber(self.spark, folder, hcp_key))

    def _over_folders(self, name: str, read: Callable[[str], DataFrame]) -> DataFrame:
        """What ``read`` finds in the folders of a table, of each only the months it holds."""
        months: dict[str, list[str] | None] = {}
        for table, month, folder in self.entries:
            if table == name:
                months.setdefault(folder, None if month is None else [])
                if month is not None:
                    months[folder].append(month)
        return reduce(DataFrame.unionByName, [
            read(folder) if held is None else read(folder).where(F.col("year_month").isin(held))
            for folder, held in months.items()])

    def read(self, name: str) -> DataFrame:
        """A warehouse table; facts also carry the ``year_month`` they are stored by."""
        columns = [*NOT_NULL[name]]
        if name.startswith("fact_"):
            return self.rows(name, LOADED).select(*columns, "year_month")
        folder = self.table(name) if self.entries is None else next(
            f for table, _, f in self.entries if table == name)
        table = self.spark.read.parquet(folder)
        return table.select(*columns, *[c for c in ("decile",) if c in table.columns])

    def star(self) -> dict[str, DataFrame]:
        return {name: self.read(name) for name in NOT_NULL}
