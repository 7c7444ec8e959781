"""Helpers the operators share: row identity, group streaming, connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.session import pin

#: The white space that separates words: blank, tab, line feed, vertical tab, form feed, return.
SPACES = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words (runs without white space) as long; null counts as empty."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def numbers(column: pa.Array | pa.ChunkedArray, null: float | int = 0) -> np.ndarray:
    if column.null_count:
        column = column.fill_null(null)
    return column.to_numpy(zero_copy_only=False)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes of all texts, offsets of each text); null counts as empty."""
    column = pa.array([], pa.string()) if len(column) == 0 else column.fill_null("")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[
        column.offset:column.offset + len(column) + 1]
    if not len(column) or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


def portions(batch: pa.RecordBatch, size: Callable[[pa.RecordBatch], np.ndarray],
             limit: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """The batch in slices of at most ``limit`` bytes (or one row), by the given row sizes."""
    if batch.num_rows == 0:
        return
    block = np.cumsum(size(batch)) // limit
    cuts = np.flatnonzero(np.diff(block)) + 1
    for start, end in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
        yield batch.slice(start, end - start)


def by_text(batch: pa.RecordBatch) -> np.ndarray:
    """Row sizes for ``portions``: the bytes of column ``text``."""
    return np.diff(text_bytes(batch["text"])[1]) + 1


def groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of rows with equal keys, from batches in which equal keys are neighbours.

    Runs that lie within a batch are slices of it; only a run that crosses batches is gathered.
    """
    held: list[pa.RecordBatch] = []

    def same(a: pa.RecordBatch, i: int, b: pa.RecordBatch, j: int) -> bool:
        return all(a[k][i].as_py() == b[k][j].as_py() for k in keys)

    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        changed = np.zeros(n - 1, bool)
        for k in keys:
            values = numbers(batch[k], -1)
            changed |= values[1:] != values[:-1]
        cuts = [0, *(np.flatnonzero(changed) + 1), n]
        for start, end in zip(cuts[:-1], cuts[1:], strict=True):
            run = batch.slice(start, end - start)
            if held and not same(held[-1], held[-1].num_rows - 1, run, 0):
                yield pa.Table.from_batches(held)
                held = []
            held.append(run)
    if held:
        yield pa.Table.from_batches(held)


def components(edges: DataFrame) -> DataFrame:
    """(id, component_id) of every id in ``edges`` (a, b): the smallest id reachable by edges.

    Large-star and small-star steps: each vertex hands its smallest neighbour first to its larger,
    then to its smaller neighbours, until all vertices hang on their smallest one. Each step is
    written down, so no step is computed twice when executors are lost. The smallest neighbours are
    dealt out anew before the join, which leaves adaptive execution free to split a hot vertex.
    """
    stars = pin(edges.where("a <> b").select(
        F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct())
    mark = None
    while True:
        seen = stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")))
        now = tuple(seen.first())
        if now == mark or now[0] == 0:
            return stars.select(F.col("hi").alias("id"), F.col("lo").alias("component_id")).union(
                stars.select("lo", "lo").distinct())
        mark = now
        both = stars.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(
            stars.select("lo", "hi"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = pin(both.where("v > u").join(least.hint("rebalance"), "u").select(
            F.col("v").alias("hi"), F.col("m").alias("lo")).distinct())
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        pairs = F.array(F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")),
                        F.struct(F.col("hi"), F.col("m").alias("lo")))
        stars = pin(large.join(least.hint("rebalance"), "hi").select(F.inline(pairs))
                    .where("hi <> lo").distinct())
