"""Hard negatives by angular triangle filtering.

Every row stores its norm and its angles to ``REFERENCES`` fixed directions. For an anchor and a row
the differences and sums of their angles to one direction enclose the angle between them (the
triangle inequality on the sphere), so all directions together give an interval of cosines and, by
the norms, an interval of scores. The angles are widened by more than rounding can have moved them
and the ends of the interval rounded outwards, so the true score always lies inside. Only rows whose
interval meets a window that is asked for, and can still reach its list, get an integer score.

Positives are searched first: an anchor meets the blocks of rows of its label and keeps its highest
scores. They open a window of scores for each positive, and the anchor then meets all blocks. The
anchors are the stated query set: they are sent to blocks of rows, at most ``BLOCK_ROWS`` a block,
and blocks hand back their best only, so a hot label or a group of copies is split like any other
rows. Directions are rows of a sample of at most ``SAMPLE`` rows (those of the least hash), chosen
far from each other; where a dimension is not in the sample, they are drawn at random.

Scores are inner products of ``floor(SCALE * x)``, exact in 64 bits; larger ones raise an error. Rows
with a null vec_id or label, a null vector or null or non-finite components take no part. Rows that
repeat vec_id, label and vector count once; rows that share only the vec_id are rows of their own,
and never partners of each other. Vectors of different length have no score. Ties go by the smaller
vec_id. An anchor without positives gives no rows; a positive with a negative score has an empty
window. Columns beyond those named are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.llm.common import groups, numbers, table
from starloom.session import pin

SCALE = 256
N_POSITIVES, N_NEGATIVES = 5, 10
LOW, HIGH, WHOLE = 30, 90, 100
REFERENCES, SAMPLE = 12, 2048
BLOCK_ROWS, LEAST_BLOCKS = 8192, 24
#: Scores below this are exact as sums of doubles.
EXACT = 2.0 ** 52
LARGEST = 2.0 ** 62


# -------------------------------------------------------------------- directions
@lru_cache(maxsize=64)
def _drawn(dim: int) -> np.ndarray:
    """Random unit directions, for dimensions no sampled row has."""
    found = np.random.default_rng(dim).normal(size=(REFERENCES, dim))
    return found / np.maximum(np.linalg.norm(found, axis=1, keepdims=True), 1e-300)


def choose(sample: list[list[int]]) -> dict[int, np.ndarray]:
    """Unit directions by dimension: sampled rows, each the one farthest from those before."""
    out = {}
    for dim in sorted({len(v) for v in sample} - {0}):
        rows = np.array([v for v in sample if len(v) == dim], np.float64)
        norm = np.linalg.norm(rows, axis=1)
        rows = rows[norm > 0] / norm[norm > 0, None]
        picked: list[np.ndarray] = []
        nearest = np.full(len(rows), -1.0)
        while len(rows) and len(picked) < REFERENCES:
            k = int(np.argmin(nearest)) if picked else 0
            picked.append(rows[k])
            # A direction and its opposite bound alike.
            nearest = np.maximum(nearest, np.abs(rows @ rows[k]))
        more = _drawn(dim)[:REFERENCES - len(picked)]
        out[dim] = np.vstack([*picked, *more])
    return out


def slack(dim: int) -> float:
    """More than rounding can have moved two stored angles, near 0 and pi too."""
    return 4 * (2 * (dim + 16) * np.finfo(np.float64).eps) ** 0.5


def _angles(vectors: np.ndarray, norms: np.ndarray, directions: np.ndarray) -> np.ndarray:
    cosines = vectors @ directions.T / np.where(norms > 0, norms, 1)[:, None]
    return np.arccos(np.clip(cosines, -1, 1))


def bounds(angles: np.ndarray, norms: np.ndarray, angle: np.ndarray, norm: float,
           dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest possible score of each row with one partner, rounded outwards."""
    spare = slack(dim)
    least = np.abs(angles - angle).max(axis=1) - spare
    total = angles + angle
    most = np.minimum(total, 2 * np.pi - total).min(axis=1) + spare
    size = norms * norm
    edge = size * 1e-9 + 1
    return (np.floor(size * np.cos(np.minimum(most, np.pi)) - edge),
            np.ceil(size * np.cos(np.maximum(least, 0)) + edge))


def _scores(vectors: np.ndarray, vector: np.ndarray, most: float) -> np.ndarray:
    if most >= LARGEST:
        raise OverflowError("an inner product does not fit into 64 bits")
    if most < EXACT:
        return (vectors @ vector).astype(np.int64)
    return vectors.astype(np.int64) @ vector.astype(np.int64)


# -------------------------------------------------------------------------- rows
def _stored(directions: dict[int, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch["vector"]
            size = np.diff(lists.offsets.to_numpy())
            flat = numbers(lists.flatten()).astype(np.float64)
            ends = np.cumsum(size)
            norms, angles = np.zeros(len(size)), [b""] * len(size)
            for dim in np.unique(size):
                at = np.flatnonzero(size == dim)
                rows = flat[(ends[at] - dim)[:, None] + np.arange(dim)]
                norms[at] = np.linalg.norm(rows, axis=1)
                known = directions.get(int(dim))
                found = _angles(rows, norms[at], _drawn(int(dim)) if known is None else known)
                for k, row in zip(at, found, strict=True):
                    angles[k] = row.tobytes()
            packed = [flat[e - n:e].tobytes() for e, n in zip(ends, size, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch["vec_id"], batch["label"], pa.array(size.astype(np.int32)),
                 pa.array(packed, pa.binary()), pa.array(norms), pa.array(angles, pa.binary())],
                ["vec_id", "label", "dim", "vector", "norm", "angles"])
    return run


STORED = "vec_id long, label long, dim int, vector binary, norm double, angles binary"


def store(vectors: DataFrame) -> DataFrame:
    """Rows that take part, with whole-number vectors, norms and angles, written down."""
    x = F.col("embedding")
    finite = ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    whole = vectors.where("vec_id is not null and label is not null").where(
        x.isNotNull() & finite).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.transform(x, lambda v: F.floor(v.cast("double") * SCALE).cast("double"))
        .alias("vector"))
    sample = whole.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE)
    directions = choose([r["vector"] for r in sample.select("vector").collect()])
    return pin(whole.mapInArrow(_stored(directions), STORED))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), np.float64).reshape(len(rows), -1)


class Block:
    """The rows of one block as arrays."""

    def __init__(self, rows: pa.Table):
        self.ids, self.labels = numbers(rows["vec_id"]), numbers(rows["label"])
        self.dim = rows["dim"][0].as_py()
        self.vectors, self.norms = _matrix(rows["vector"]), numbers(rows["norm"])
        self.angles = _matrix(rows["angles"])

    def bounds(self, angle: np.ndarray, norm: float) -> tuple[np.ndarray, np.ndarray]:
        return bounds(self.angles, self.norms, angle, norm, self.dim)

    def scores(self, at: np.ndarray, vector: np.ndarray, norm: float) -> np.ndarray:
        most = float(self.norms[at].max(initial=0)) * norm
        return _scores(self.vectors[at], vector, most)


def _highest(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` first by falling score, then rising id; repeated rows count once."""
    if len(scores) > 4 * k:
        near = np.flatnonzero(scores >= np.partition(scores, -k)[-k])
    else:
        near = np.arange(len(scores))
    order = near[np.lexsort((ids[near], -scores[near]))]
    new = np.ones(len(order), bool)
    new[1:] = (ids[order][1:] != ids[order][:-1]) | (scores[order][1:] != scores[order][:-1])
    return order[new][:k]


def _kth(values: np.ndarray, k: int) -> float:
    return np.partition(values, -k)[-k] if len(values) >= k else -np.inf


Search = Callable[[Block, dict], Iterator[tuple]]


def _meet(search: Search, names: list[str]):
    """Rows of a block are held; the anchors that follow are searched one by one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, at = None, None
        for part in groups(batches, ["block", "turn"]):
            number = part["block"][0].as_py()
            if part["turn"][0].as_py() == 0:
                block, at = Block(part), number
                continue
            if at != number:
                raise ValueError("anchors without the rows of their block")
            for piece in part.to_batches(max_chunksize=512):
                found = [r for anchor in piece.to_pylist() for r in search(block, anchor)]
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names)
    return run


# ------------------------------------------------------------------------ search
def _positives(block: Block, anchor: dict) -> Iterator[tuple]:
    angle, norm = np.frombuffer(anchor["angles"]), anchor["norm"]
    other = (block.labels == anchor["label"]) & (block.ids != anchor["vec_id"])
    at = np.flatnonzero(other)
    if len(at):
        low, high = block.bounds(angle, norm)
        # Repeated rows count once, so they raise the bar once.
        _, once = np.unique(block.ids[at], return_index=True)
        at = at[high[at] >= _kth(low[at[once]], N_POSITIVES)]
        scores = block.scores(at, np.frombuffer(anchor["vector"]), norm)
        for k in _highest(block.ids[at], scores, N_POSITIVES):
            yield (anchor["anchor"], anchor["vec_id"], int(block.ids[at[k]]), int(scores[k]))


def _negatives(block: Block, anchor: dict) -> Iterator[tuple]:
    angle, norm = np.frombuffer(anchor["angles"]), anchor["norm"]
    other = block.labels != anchor["label"]
    low, high = block.bounds(angle, norm)
    windows, wanted = [], np.zeros(len(other), bool)
    for positive in anchor["positives"]:
        score = positive["score"]
        least, most = -(-LOW * score // WHOLE), HIGH * score // WHOLE
        meets = other & (high >= least) & (low <= most)
        inside = np.flatnonzero(meets & (low >= least) & (high <= most))
        _, once = np.unique(block.ids[inside], return_index=True)
        wanted |= meets & (high >= _kth(low[inside[once]], N_NEGATIVES))
        windows.append((positive["id"], score, least, most))
    at = np.flatnonzero(wanted)
    if not len(at):
        return
    ids, scores = block.ids[at], block.scores(at, np.frombuffer(anchor["vector"]), norm)
    for positive, score, least, most in windows:
        fits = np.flatnonzero((scores >= least) & (scores <= most))
        for k in _highest(ids[fits], scores[fits], N_NEGATIVES):
            yield (anchor["anchor"], anchor["vec_id"], positive, score,
                   int(ids[fits[k]]), int(scores[fits[k]]))


def _in_blocks(rows: DataFrame, anchors: DataFrame, group: list[str], search: Search,
               names: list[str]) -> DataFrame:
    """Search each anchor in all blocks of rows that agree with it in ``group``."""
    sizes = pin(rows.groupBy(*group).agg(F.count(F.lit(1)).alias("n")))
    least = LEAST_BLOCKS if group == ["dim"] else 1
    sizes = sizes.select(*group, F.greatest(
        F.ceil(F.col("n") / BLOCK_ROWS), F.lit(least)).cast("long").alias("blocks"))
    part = F.pmod(F.xxhash64("vec_id", "vector"), "blocks")
    block = F.xxhash64(*group, "part").alias("block")
    extra = [c for c in anchors.columns if c not in rows.columns]
    held = rows.join(sizes, group).withColumn("part", part).select(
        "*", block, F.lit(0).alias("turn"), *[
            F.lit(None).cast(anchors.schema[c].dataType).alias(c) for c in extra])
    # A block without rows would leave its anchors nothing to meet.
    there = pin(held.select("block").distinct())
    asked = anchors.join(sizes, group).withColumn(
        "part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
        "*", block, F.lit(1).alias("turn")).join(there, "block", "left_semi")
    columns = ["block", "turn", *rows.columns, *extra]
    return held.select(*columns).union(asked.select(*columns)).repartition(
        "block").sortWithinPartitions("block", "turn").mapInArrow(
        _meet(search, names), ", ".join(f"{c} long" for c in names))


def mine(vectors: DataFrame, every: int = 100) -> DataFrame:
    """Hard negatives of the rows of ``vectors`` (vec_id, embedding, label) whose id ``every``
    divides: (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).
    """
    rows = store(vectors)
    anchors = pin(rows.where(F.col("vec_id") % every == 0).dropDuplicates(
        ["vec_id", "label", "vector"]).withColumn(
        "anchor", F.xxhash64("vec_id", "label", "vector")))
    found = _in_blocks(rows, anchors, ["dim", "label"], _positives,
                       ["anchor", "anchor_id", "positive_id", "score"])
    first = Window.partitionBy("anchor").orderBy(F.desc("score"), "positive_id")
    lists = (found.distinct().withColumn("place", F.row_number().over(first))
             .where(F.col("place") <= N_POSITIVES).groupBy("anchor").agg(
                 F.collect_list(F.struct(F.col("positive_id").alias("id"), "score"))
                 .alias("positives")))
    asked = pin(anchors.join(lists, "anchor"))
    near = _in_blocks(rows, asked, ["dim"], _negatives, [
        "anchor", "anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"])
    best = Window.partitionBy("anchor", "positive_id", "positive_score").orderBy(
        F.desc("negative_score"), "negative_id")
    return near.distinct().withColumn("rank", F.row_number().over(best)).where(
        F.col("rank") <= N_NEGATIVES).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


# ----------------------------------------------------------------------- queries
def relabelled(vectors: DataFrame) -> DataFrame:
    """Rows whose vec_id 7 divides move on to the next of ten labels."""
    label = F.col("label").cast("long")
    return vectors.select("vec_id", "embedding", F.when(
        F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine(relabelled(table(spark, sf_dir, "embeddings")))


OP12_SQL = """
with usable as (
  select vec_id, (case when vec_id % 7 = 0 then (label + 1) % 10 else label end)::bigint as label,
         list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select a.vec_id as anchor_id, r.vec_id as other_id, a.label = r.label as same,
         list_dot_product(a.v, r.v)::bigint as score
  from usable a join usable r on a.vec_id % 100 = 0 and a.vec_id <> r.vec_id
    and len(a.v) = len(r.v)
), positives as (
  select anchor_id, other_id as positive_id, score as positive_score from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5
)
select p.anchor_id, p.positive_id,
  (row_number() over (partition by p.anchor_id, p.positive_id
                      order by s.score desc, s.other_id))::int as rank,
  s.other_id as negative_id, p.positive_score, s.score as negative_score
from positives p join scored s on p.anchor_id = s.anchor_id and not s.same
  and 30 * p.positive_score <= 100 * s.score and 100 * s.score <= 90 * p.positive_score
qualify rank <= 10
"""
