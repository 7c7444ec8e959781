"""Toxicity: a linear classifier that is told not to care which group of people a text mentions.

The score is logistic in the densities of selected words and word starts (4 to 6 bytes), per hundred
words. It is fitted on at most ``MAX_LABELLED`` labelled documents per class, those with the
smallest hash of their id; nothing else about the fit is limited. For each of them that mentions a
group (``IDENTITY``, or the terms that are given) a copy is made in which the terms are swapped for
others of the same kind, and the squared change of the score's logit between the two is added to the
loss. So a group's name gets no weight of its own, however unevenly the labels mention it.

Labels of ids in fold 1 are never learnt from. The weight of the ridge is chosen among ``RIDGES`` by
what a fit on one of the other two folds loses on the other; nothing is chosen on fold 1.

Null and empty texts, and texts without words, get the score of a text in which nothing was found.
Rows without a doc_id are scored but never learnt from; of several labels of one doc_id the highest
counts; null labels are no labels. Without labels of both classes the score is the share of toxic
labels (0 without any). Repeated rows are scored alike, other columns are passed through by ``keep_clean``
and ignored otherwise.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import by_text, numbers, portions, table, text_bytes
from starloom.llm.wordhash import Words, mix, separators, words
from starloom.session import pin

# Terms for groups of people, by kind; terms of a kind are swapped for each other.
IDENTITY = {
    "gender": ("women", "men", "girls", "boys"),
    "faith": ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    "origin": ("africans", "asians", "europeans", "americans", "mexicans", "immigrants"),
    "colour": ("black", "white", "brown"),
    "orientation": ("gay", "lesbian", "straight", "bisexual"),
    "age": ("old", "young"),
    "ability": ("blind", "deaf", "disabled"),
}
MAX_LABELLED = 4000
N_FEATURES = 512
LEAST_DOCUMENTS = 4
STARTS = (4, 5, 6)
THRESHOLD = 0.7
FLOOR, FAIRNESS, STEPS, RATE = 0.2, 1.0, 400, 0.3
RIDGES = (0.1, 0.5, 2.0)
BREAKS = separators(" \t\n\x0b\f\r!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~")
SLOT_BITS = 20


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3; 1 is the fold that is never learnt from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


# -------------------------------------------------------------------- features
def _features(found: Words) -> tuple[np.ndarray, np.ndarray]:
    """(document, feature) of every word and of the starts of longer words."""
    document, size = found.document(), found.end - found.start
    hashes, documents = [found.hashes()], [document]
    for n in STARTS:
        longer = size > n
        part = Words(found.start[longer], found.end[longer], found.first, found._sums,
                     found._unpower)
        hashes.append(part.hashes(np.int64(n)) ^ np.uint64(n))
        documents.append(document[longer])
    return np.concatenate(documents), np.concatenate(hashes)


@dataclass
class Model:
    features: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float | None = None  # a constant score instead

    def __post_init__(self) -> None:
        for self.factor in np.arange(1, 10_000, dtype=np.uint64):  # a draw without collisions
            slots = self._slot(self.features)
            if len(np.unique(slots)) == len(slots):
                break
        self.at = np.full(1 << SLOT_BITS, -1, np.int32)
        self.at[slots] = np.arange(len(slots))

    def _slot(self, hashes: np.ndarray) -> np.ndarray:
        return (mix(hashes ^ self.factor) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)

    def find(self, found: Words) -> tuple[np.ndarray, np.ndarray]:
        """(document, number of the feature) of every selected feature found."""
        document, hashes = _features(found)
        at = self.at[self._slot(hashes)]
        hit = np.flatnonzero(at >= 0)
        hit = hit[self.features[at[hit]] == hashes[hit]]
        return document[hit], at[hit]

    def score(self, found: Words) -> np.ndarray:
        counts = np.diff(found.first)
        if self.prior is not None:
            return np.full(len(counts), self.prior)
        document, at = self.find(found)
        total = np.bincount(document, self.weights[at], len(counts))
        logit = self.bias + total * 100 / np.maximum(counts, 1)
        return 1 / (1 + np.exp(-np.clip(logit, -500, 500)))


# ------------------------------------------------------------------------- fit
Terms = Mapping[str, Sequence[str]]


class Swap:
    """Replaces each group's term in a text by the next one of its kind."""

    def __init__(self, terms: Terms = IDENTITY):
        self.next = {term: other for kind in terms.values() for term, other in
                     zip(kind, (*kind[1:], *kind[:1]), strict=True)}
        listed = "|".join(re.escape(t) for t in self.next)
        self.pattern = re.compile(rf"\b({listed})\b" if listed else r"(?!)",
                                  re.IGNORECASE | re.ASCII)

    def __call__(self, text: str) -> str:
        return self.pattern.sub(lambda m: self.next[m[0].lower()], text)


def labelled_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, toxic) of at most ``MAX_LABELLED`` labelled documents per class."""
    known = labels.where(F.col("toxic").isin(0, 1) & (fold(F.col("doc_id")) != 1)).groupBy(
        F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    order = F.xxhash64("doc_id")
    chosen = [known.where(F.col("toxic") == c).orderBy(order, "doc_id").limit(MAX_LABELLED)
              for c in (0, 1)]
    # At most 2 * MAX_LABELLED pairs of numbers: small enough to send to every task.
    chosen = F.broadcast(chosen[0].union(chosen[1]))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(chosen, "doc_id")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per portion: in how many documents of either class each feature occurs."""
    for batch in batches:
        for part in portions(batch, by_text):
            toxic = numbers(part["toxic"]).astype(bool)
            document, hashes = _features(words(*text_bytes(part["text"]), BREAKS))
            order = np.lexsort((document, hashes))
            hashes, document = hashes[order], document[order]
            new = np.ones(len(hashes), bool)
            new[1:] = (hashes[1:] != hashes[:-1]) | (document[1:] != document[:-1])
            distinct, at = np.unique(hashes[new], return_inverse=True)
            ones = np.bincount(at, toxic[document[new]], len(distinct)).astype(np.int64)
            both = np.bincount(at, minlength=len(distinct)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(distinct.view(np.int64)), pa.array(both - ones), pa.array(ones)],
                ["feature", "clean", "toxic"])


def select_features(sample: DataFrame, n_clean: int, n_toxic: int, terms: Sequence[str]
                    ) -> np.ndarray:
    """The ``N_FEATURES`` features whose log odds between the classes stand out most, and ``terms``."""
    counts = sample.mapInArrow(_counted, "feature long, clean long, toxic long").groupBy(
        "feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    odds = lambda c, n: F.log((F.col(c) + 0.5) / (n + 0.5 - F.col(c)))
    spread = F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    best = (counts.where(F.col("clean") + F.col("toxic") >= LEAST_DOCUMENTS)
            .withColumn("z", F.abs(odds("toxic", n_toxic) - odds("clean", n_clean)) / spread)
            .orderBy(F.desc("z"), "feature").limit(N_FEATURES).select("feature"))
    chosen = [r["feature"] for r in best.collect()]
    _, named = _features(words(*text_bytes(pa.array(list(terms), pa.string())), BREAKS))
    return np.unique(np.concatenate([np.array(chosen, np.int64).view(np.uint64), named]))


def _vectors(model: Model, swap: Swap):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in portions(batch, by_text):
                texts = part["text"].fill_null("").to_pylist()
                both = [words(*text_bytes(pa.array(t, pa.string())), BREAKS)
                        for t in (texts, [swap(t) for t in texts])]
                cells = []
                for kind, found in enumerate(both):
                    n, width = part.num_rows, len(model.features)
                    document, at = model.find(found)
                    cell, times = np.unique(document * width + at, return_counts=True)
                    share = times * 100 / np.maximum(np.diff(found.first), 1)[cell // width]
                    cuts = np.searchsorted(cell, np.arange(n + 1) * width)
                    for values, t in ((cell % width, pa.int32()), (share, pa.float32())):
                        cells.append(pa.ListArray.from_arrays(
                            pa.array(cuts, pa.int32()), pa.array(values).cast(t)))
                yield pa.RecordBatch.from_arrays(
                    [part["toxic"].cast(pa.int32()), part["fold"], *cells],
                    ["toxic", "fold", "at", "share", "at_swap", "share_swap"])
    return run


def _dense(rows: list, at: str, share: str, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width), np.float32)
    for i, r in enumerate(rows):
        out[i, r[at]] = r[share]
    return out


@dataclass
class Sample:
    """Densities of labelled texts, and how a swap of terms changes those that mention a group."""

    x: np.ndarray
    y: np.ndarray
    change: np.ndarray

    def weight(self) -> np.ndarray:
        ones = max(1.0, float(self.y.sum()))
        return np.where(self.y == 1, 0.5 / ones, 0.5 / max(1.0, len(self.y) - ones)).astype(
            np.float32)

    def loss(self, w: np.ndarray, bias: float) -> float:
        """Log loss, both classes weighing the same."""
        margin = np.where(self.y == 1, 1, -1) * (self.x @ w + bias)
        return float((self.weight() * np.logaddexp(0, -margin)).sum())


def descend(sample: Sample, ridge: float, fairness: float) -> tuple[np.ndarray, float]:
    """Weights and bias by Adam on the whole sample."""
    x, y, change, weight = sample.x, sample.y, sample.change, sample.weight()
    w, bias = np.zeros(x.shape[1], np.float32), 0.0
    moment, square, b_moment, b_square = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for step in range(1, STEPS + 1):
        error = weight * (1 / (1 + np.exp(-np.clip(x @ w + bias, -60, 60))) - y)
        slope = x.T @ error + ridge / len(x) * w
        if len(change):
            slope += fairness * change.T @ (change @ w) / len(change)
        b_slope = error.sum()
        moment, square = 0.9 * moment + 0.1 * slope, 0.99 * square + 0.01 * slope ** 2
        b_moment, b_square = 0.9 * b_moment + 0.1 * b_slope, 0.99 * b_square + 0.01 * b_slope ** 2
        first, second = 1 - 0.9 ** step, 1 - 0.99 ** step
        w -= RATE * (1 - step / STEPS) * (moment / first) / (np.sqrt(square / second) + 1e-8)
        bias -= RATE * (1 - step / STEPS) * (b_moment / first) / (np.sqrt(b_square / second) + 1e-8)
    return w, float(bias)


def chosen_ridge(sample: Sample, fold: np.ndarray, group: np.ndarray, fairness: float) -> float:
    """The ridge whose fits on one fold lose least on the other; ``group`` is the fold of changes."""
    parts = [Sample(sample.x[fold == f], sample.y[fold == f], sample.change[group == f])
             for f in (0, 2)]
    if any(len(set(p.y)) < 2 for p in parts):
        return RIDGES[len(RIDGES) // 2]
    losses = {r: sum(other.loss(*descend(part, r, fairness))
                     for part, other in (parts, parts[::-1])) for r in RIDGES}
    return min(RIDGES, key=lambda r: losses[r])


def fit(docs: DataFrame, labels: DataFrame, fairness: float = FAIRNESS,
        terms: Terms = IDENTITY) -> Model:
    """The classifier; what reaches the driver is bounded by ``MAX_LABELLED`` and ``N_FEATURES``."""
    picked = pin(labelled_sample(docs, labels).withColumn(
        "fold", fold(F.col("doc_id")).cast("int")))
    seen = {r["toxic"]: r["count"] for r in picked.groupBy("toxic").count().collect()}
    n_clean, n_toxic = seen.get(0, 0), seen.get(1, 0)
    none = np.zeros(0, np.uint64)
    if not n_clean or not n_toxic:
        return Model(none, none, 0.0, n_toxic / max(1, n_clean + n_toxic))
    swap = Swap(terms)
    features = select_features(picked, n_clean, n_toxic, list(swap.next))
    model = Model(features, np.zeros(len(features)), 0.0)
    rows = picked.mapInArrow(
        _vectors(model, swap), "toxic int, fold int, at array<int>, share array<float>, "
        "at_swap array<int>, share_swap array<float>").collect()
    x = _dense(rows, "at", "share", len(features))
    mentions = [r for r in rows if r["at"] != r["at_swap"] or r["share"] != r["share_swap"]]
    change = _dense(mentions, "at_swap", "share_swap", len(features)) - _dense(
        mentions, "at", "share", len(features))
    size = np.sqrt((x ** 2).mean(axis=0)) + FLOOR
    sample = Sample(x / size, np.array([r["toxic"] for r in rows], np.float32), change / size)
    ridge = chosen_ridge(sample, np.array([r["fold"] for r in rows]),
                         np.array([r["fold"] for r in mentions]), fairness)
    w, bias = descend(sample, ridge, fairness)
    return Model(features, w.astype(np.float64) / size, bias)


# ----------------------------------------------------------------------- score
def score(docs: DataFrame, model: Model, column: str = "toxicity") -> DataFrame:
    """``docs`` with the score, from the text alone; ``column`` must be a new name."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in portions(batch, by_text):
                found = words(*text_bytes(part["text"]), BREAKS)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(shared.value.score(found))],
                    [*part.schema.names, column])
    return docs.mapInArrow(run, schema)


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is below the threshold."""
    column = "toxicity"
    while column in docs.columns:
        column += "_"
    return score(docs, fit(docs, labels), column).where(F.col(column) < THRESHOLD).drop(column)


# --------------------------------------------------------------------- queries
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select(
        "doc_id", F.coalesce(fold(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= THRESHOLD).cast("int").alias("predicted"))
