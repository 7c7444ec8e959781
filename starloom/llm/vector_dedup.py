"""Near-duplicate vectors: a neighbour graph by NN-descent, of which threshold edges are kept.

Equal vectors of a label are one node. The graph starts from random projections: vectors of a label
are sorted by the signs of their projections and compared with the next few in that order, in as many
projections as leave a lone pair at the threshold unseen with probability ``UNSEEN`` at most, so in
more for larger labels. Then, in
rounds, all neighbours of a node (also those that list it) are compared with each other and improve
each other's lists. A node whose list is full of vectors within the threshold gets a list twice as
long, up to ``LONGEST``. Edges within the threshold form components, also those that no list has room
for: of what a comparison finds, as many are kept as tie the same vectors together. A list full of
vectors within the threshold may still hide links; nodes with such lists are compared exactly, block by
block, across any two components that lie near enough to each other to be linked.

The result is audited: a bounded, documented number of vectors, equally many from components of 1, of 2
or 3, of 4 to 7 and of more nodes, is compared with all of their label. Each vector with links counts
alike, whatever their number; as long as in one of these classes too many links are not inside a
component, further projections are added and
the rounds repeated. If that does not help, the exact comparison takes in all vectors. Links are finally counted exactly inside each component, in tiles of a bounded
number of vectors, so vectors with more links than any list holds are counted right, and no pair of
a group is ever written out. All similarities are computed in double precision.

Vectors that are null, empty, zero or hold null or non-finite components, and vectors without a
label, are linked with nothing; vectors of different lengths neither. Rows that repeat a vec_id are
one vector for components but counted as links of their own; without a vec_id component_id is null
and kept is true. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.llm.common import components, groups, numbers, table
from starloom.session import pin

THRESHOLD = 0.93
TABLES, BITS, AHEAD = 24, 32, 16
LIST, LONGEST, ROUNDS = 8, 64, 3
UNSEEN = 0.001
AUDITED, CLASSES, RECALL, TRIES = 1000, 4, 0.995, 3
TILE = 256
EDGE = "a long, b long, sim double, tie boolean"
NODE = ("label", "dim")


def _unit(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows of length one."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = flat.reshape(len(column), -1)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # no overflow, no underflow
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def nodes_of(vectors: DataFrame) -> DataFrame:
    """(id, label, dim, vec, copies): distinct usable vectors, named by their smallest vec_id."""
    good = (F.col("vec").isNotNull() & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
            & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
            & F.exists("vec", lambda x: x != 0))
    return vectors.where(F.coalesce(good, F.lit(False))).groupBy("label", "vec").agg(
        F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("copies")).withColumn(
        "dim", F.size("vec"))


# ------------------------------------------------------------- first neighbours
def tables_for(size: int, threshold: float) -> int:
    """Projections for a label of ``size`` nodes.

    Two vectors get the same sign with probability 1 - angle / pi. Those that agree in the first
    log2(size / AHEAD) signs share them with about ``AHEAD`` nodes, so are compared.
    """
    if size <= AHEAD:
        return TABLES
    met = (1 - math.acos(threshold) / math.pi) ** math.log2(size / AHEAD)
    return max(TABLES, math.ceil(math.log(UNSEEN) / math.log1p(-met)))


def _projected(seed: int, large: dict[tuple[int, int], int]):
    """Rows of each projection; ``large`` has the numbers of projections other than ``TABLES``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            dims, labels = numbers(batch["dim"]), numbers(batch["label"])
            for dim, tables in {(int(d), large.get((int(n), int(d)), TABLES))
                                for n, d in set(zip(labels, dims, strict=True))}:
                those = [n for n in np.unique(labels) if large.get((int(n), dim), TABLES) == tables]
                part = batch.filter(pa.array((dims == dim) & np.isin(labels, those)))
                if len(planes.get(dim, ())) < tables:  # the first ones are the same for any number
                    draw = np.random.default_rng([seed, dim])
                    planes[dim] = draw.standard_normal((tables, dim, BITS))
                rows = _unit(part["vec"])
                for t in range(tables):
                    signs = rows @ planes[dim][t] > 0
                    code = signs @ (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(rows), t, np.int32)), part["label"], part["dim"],
                         pa.array(code), part["id"], part["vec"]],
                        ["table", "label", "dim", "code", "id", "vec"])
    return run


def _next_in_order(threshold: float):
    """Compares each row with the next ones of its (table, label, dim), also across batches.

    Edges within the threshold are ties, but not those between rows that a chain of neighbours ties.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            new_from = 0 if held is None else held.num_rows
            keys = [numbers(batch[k]) for k in ("table", "label", "dim")]
            ids, n = numbers(batch["id"]), batch.num_rows
            out = []
            for dim in np.unique(keys[2]):
                at = np.flatnonzero(keys[2] == dim)
                rows = _unit(batch["vec"].take(pa.array(at)))
                chain = np.zeros(len(at), np.int64)
                for step in range(1, AHEAD + 1):
                    same = (keys[0][at][step:] == keys[0][at][:-step]) & (
                        keys[1][at][step:] == keys[1][at][:-step])
                    if step > 1:
                        same &= at[step:] >= new_from
                    i = np.flatnonzero(same)
                    sims = np.einsum("ij,ij->i", rows[i], rows[i + step])
                    tie = sims >= threshold
                    if step == 1:
                        broken = np.ones(len(at), bool)
                        broken[i[tie] + 1] = False
                        chain = np.cumsum(broken)
                        new = at[i + 1] >= new_from
                        i, sims, tie = i[new], sims[new], tie[new]
                    else:
                        tie &= chain[i] != chain[i + step]
                    out.append((ids[at[i]], ids[at[i + step]], sims, tie))
            if out:
                yield _edges(*(np.concatenate(x) for x in zip(*out, strict=True)))
            held = batch.slice(max(0, n - AHEAD))
    return run


def _edges(a: np.ndarray, b: np.ndarray, sim: np.ndarray, tie: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (a, b, sim, tie)],
                                      ["a", "b", "sim", "tie"])


def large_labels(nodes: DataFrame, threshold: float) -> dict[tuple[int, int], int]:
    """The number of projections by (label, dim), where it is more than ``TABLES``: few large labels."""
    least = AHEAD
    while tables_for(least, threshold) == TABLES:
        least *= 2
    sizes = nodes.groupBy(*NODE).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > least // 2)
    return {(r["label"], r["dim"]): tables_for(r["n"], threshold) for r in sizes.collect()}


def first_edges(nodes: DataFrame, seed: int, threshold: float,
                large: dict[tuple[int, int], int]) -> DataFrame:
    order = ["table", "label", "dim", "code", "id"]
    return (
        nodes.select("label", "dim", "id", "vec")
        .mapInArrow(_projected(seed, large),
                    "table int, label int, dim int, code long, id long, vec array<float>")
        .repartitionByRange(*order).sortWithinPartitions(*order)
        .mapInArrow(_next_in_order(threshold), EDGE)
    )


# ------------------------------------------------------------------ NN-descent
def nearest(edges: DataFrame, lists: DataFrame, threshold: float) -> DataFrame:
    """Each node's nearest: both directions of ``edges``, cut to the length of the node's list.

    ``listed`` tells the rows of the lists; ties and what was listed within the threshold stay beside
    them once, from the smaller id.
    """
    both = edges.select("a", "b", "sim", "tie").union(edges.select("b", "a", "sim", "tie")).where(
        "a <> b").groupBy("a", "b").agg(F.max("sim").alias("sim"), F.max("tie").alias("tie"))
    place = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("sim"), "b"))
    ranked = both.withColumn("place", place)
    ranked = ranked.where((F.col("place") <= LONGEST) | (F.col("tie") & (F.col("a") < F.col("b"))))
    listed = F.col("place") <= F.col("k")
    return ranked.join(lists.hint("rebalance"), ranked.a == lists.id).select(
        "a", "b", "sim", (F.col("tie") | (listed & (F.col("sim") >= threshold))).alias("tie"),
        listed.alias("listed")).where(F.col("listed") | (F.col("tie") & (F.col("a") < F.col("b"))))


def _forest(hit: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that tie together what the symmetric matrix ``hit`` does; trees grow from ``start`` on."""
    left, pairs = hit.any(axis=1), []
    for root in np.roll(np.arange(len(hit)), -start):
        if not left[root]:
            continue
        left[root], front = False, np.array([root])
        while len(front):
            new = np.flatnonzero(hit[front].any(axis=0) & left)
            pairs.append((front[hit[np.ix_(front, new)].argmax(axis=0)], new))
            left[new], front = False, new
    if not pairs:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    i, j = (np.concatenate(x) for x in zip(*pairs, strict=True))
    return i, j


def _local_join(threshold: float):
    """All pairs among a node's neighbours that would improve one of the two lists, and ties.

    Neighbours within the threshold of the node itself are tied already.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for near in groups(batches, ["u"]):
            if near.num_rows < 2:
                continue
            ids, worst = numbers(near["v"]), numbers(near["worst"])
            rows, tied = _unit(near["vec"]), numbers(near["sim"]) >= threshold
            sims = rows @ rows.T
            i, j = np.triu_indices(len(ids), 1)
            better = sims[i, j] > np.minimum(worst[i], worst[j])
            i, j = i[better], j[better]
            if len(i):
                yield _edges(ids[i], ids[j], sims[i, j], np.zeros(len(i), bool))
            hit = (sims >= threshold) & ~(tied[:, None] & tied[None, :])
            np.fill_diagonal(hit, False)
            if hit.any():
                i, j = _forest(hit, int(near["u"][0].as_py() % len(ids)))
                yield _edges(ids[i], ids[j], sims[i, j], np.ones(len(i), bool))
    return run


def improved(graph: DataFrame, nodes: DataFrame, lists: DataFrame, threshold: float) -> DataFrame:
    """Edges found through neighbours of neighbours."""
    listing = Window.partitionBy("u").orderBy(F.desc("sim"), "v")
    back = (graph.select(F.col("b").alias("u"), F.col("a").alias("v"), "sim")
            .withColumn("place", F.row_number().over(listing)).where(F.col("place") <= LONGEST))
    near = graph.select(F.col("a").alias("u"), F.col("b").alias("v"), "sim").union(
        back.select("u", "v", "sim")).groupBy("u", "v").agg(F.max("sim").alias("sim"))
    worst = graph.groupBy("a").agg(F.min("sim").alias("least"), F.count(F.lit(1)).alias("n"))
    worst = lists.join(worst, lists.id == worst.a, "left").select(
        F.col("id").alias("v"), F.when(F.col("n") >= F.col("k"), F.col("least")).otherwise(-2.0)
        .alias("worst"))
    known = nodes.select(F.col("id").alias("v"), "vec").join(worst, "v")
    joined = near.join(known.hint("rebalance"), "v").repartition("u").sortWithinPartitions("u")
    return joined.select("u", "v", "sim", "worst", "vec").mapInArrow(_local_join(threshold), EDGE)


def longer_lists(graph: DataFrame, lists: DataFrame, threshold: float) -> DataFrame:
    """Lists full of vectors within the threshold double, up to ``LONGEST``."""
    least = graph.groupBy("a").agg(F.min("sim").alias("least"), F.count(F.lit(1)).alias("n"))
    full = (F.col("n") >= F.col("k")) & (F.col("least") >= threshold)
    return lists.join(least, lists.id == least.a, "left").select(
        "id", F.when(full, F.least(F.col("k") * 2, F.lit(LONGEST))).otherwise(F.col("k"))
        .cast("int").alias("k"))


def full_lists(graph: DataFrame, threshold: float) -> DataFrame:
    """(id) of the nodes whose lists hold vectors within the threshold only, so may hide more."""
    return graph.groupBy("a").agg(F.min("sim").alias("least"), F.count(F.lit(1)).alias("n")).where(
        (F.col("least") >= threshold) & (F.col("n") >= LIST)).select(F.col("a").alias("id"))


# ------------------------------------------------------------ exact comparison
def _from_centre(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        dims = numbers(batch["dim"])
        for dim in np.unique(dims):
            part = batch.filter(pa.array(dims == dim))
            cos = np.einsum("ij,ij->i", _unit(part["vec"]), _unit(part["centre"]))
            yield pa.RecordBatch.from_arrays([part["component_id"], pa.array(cos)],
                                             ["component_id", "cos"])


def _balls_in_reach(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in groups(batches, ["label", "dim", "i", "j"]):
            block, i, j = numbers(tile["block"]), tile["i"][0].as_py(), tile["j"][0].as_py()
            ids, size, blocks = (numbers(tile[k]) for k in ("component_id", "size", "blocks"))
            rows = _unit(tile["centre"])
            radius = np.arccos(np.clip(numbers(tile["cos"]), -1, 1))
            radius[size == 1] = 0
            left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
            apart = np.arccos(np.clip(rows[left] @ rows[right].T, -1, 1))
            reach = radius[left][:, None] + radius[right][None, :] + np.arccos(threshold) + 1e-6
            near = apart <= reach
            if i == j:
                near = np.triu(near, 1)
            x, y = np.nonzero(near)
            x, y = left[x], right[y]
            if len(x):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v) for v in (ids[x], ids[y], blocks[x], blocks[y])],
                    ["x", "y", "x_blocks", "y_blocks"])
    return run


def _first_tie(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in groups(batches, ["x", "y", "i", "j"]):
            ids, side, rows = numbers(tile["id"]), numbers(tile["side"]), _unit(tile["vec"])
            left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            hit = np.argwhere(rows[left] @ rows[right].T >= threshold)[:1]
            if len(hit):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[left[hit[:, 0]]]), pa.array(ids[right[hit[:, 1]]])], ["a", "b"])
    return run


def missing_ties(nodes: DataFrame, tied: DataFrame, threshold: float) -> DataFrame:
    """(a, b) that tie any two components of which some of ``nodes`` are linked; nothing is left out.

    Two components can be linked only if their balls, each about the member with the smallest id, come
    as near as the threshold; of such pairs all members are compared, in tiles.
    """
    members = pin(nodes.join(tied, "id", "left").select(
        "id", "label", "dim", "vec", F.coalesce("component_id", "id").alias("component_id")))
    centres = members.groupBy("component_id").agg(
        F.min_by(F.struct("label", "dim", F.col("vec").alias("centre")), "id").alias("c"),
        F.count(F.lit(1)).alias("size")).select("component_id", "size", "c.*")
    centres = pin(centres.withColumn("blocks", F.ceil(F.col("size") / TILE).cast("int")))
    least = members.join(centres.select("component_id", "centre").hint("rebalance"), "component_id").select(
        "component_id", "dim", "vec", "centre").mapInArrow(
        _from_centre, "component_id long, cos double").groupBy("component_id").agg(
        F.min("cos").alias("cos"))
    groups_of = centres.groupBy(*NODE).agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("parts"))
    both = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda other: F.struct(
        F.least("block", other).alias("i"), F.greatest("block", other).alias("j")))
    key = [*NODE, "i", "j"]
    balls = (centres.join(least, "component_id").join(groups_of.hint("rebalance"), list(NODE))
             .withColumn("block", F.pmod(F.xxhash64("component_id"), "parts").cast("int"))
             .select("component_id", "size", "blocks", "centre", "cos", *NODE, "block", F.inline(both)))
    pairs = pin(balls.repartition(*key).sortWithinPartitions(*key).mapInArrow(
        _balls_in_reach(threshold), "x long, y long, x_blocks int, y_blocks int"))

    def side(number: int, own: str, other: str, own_block: str, other_block: str) -> DataFrame:
        joined = members.join(pairs.hint("rebalance"), members.component_id == pairs[own])
        return joined.withColumn(own_block, F.pmod(F.xxhash64("id"), f"{own}_blocks").cast("int")).withColumn(
            other_block, F.explode(F.sequence(F.lit(0), F.col(f"{other}_blocks") - 1))).select(
            "x", "y", "i", "j", F.lit(number).alias("side"), "id", "vec")

    tile = ["x", "y", "i", "j"]
    rows = side(0, "x", "y", "i", "j").union(side(1, "y", "x", "j", "i"))
    return rows.repartition(*tile).sortWithinPartitions(*tile).mapInArrow(
        _first_tie(threshold), "a long, b long")


def with_missing(nodes: DataFrame, tied: DataFrame, threshold: float) -> DataFrame:
    """``tied`` after the exact comparison of ``nodes``."""
    more = pin(missing_ties(nodes, tied, threshold))
    if more.isEmpty():
        return tied
    return pin(components(more.union(tied.select("id", "component_id"))))


# --------------------------------------------------------------- audit, counts
def audit(nodes: DataFrame, tied: DataFrame, threshold: float) -> float:
    """The mean share of an audited node's true links that lie inside its component.

    Nodes are audited by the size of their component, equally many (smallest hashes) for each of
    ``CLASSES``, and the least of these classes' shares counts.
    """
    named = nodes.join(tied, "id", "left").select(
        "id", "label", "dim", "vec", F.coalesce("component_id", "id").alias("component_id"))
    size = tied.groupBy("component_id").agg(F.count(F.lit(1)).alias("size"))
    grade = F.least(F.floor(F.log2(F.coalesce("size", F.lit(1)))), F.lit(CLASSES - 1)).cast("int")
    named = pin(named.join(size.hint("rebalance"), "component_id", "left").withColumn("grade", grade))
    asked = pd.concat([named.where(F.col("grade") == k).orderBy(F.xxhash64("id"), "id").limit(
        AUDITED // CLASSES).toPandas() for k in range(CLASSES)])
    grades = dict(zip(asked["id"].tolist(), asked["grade"].tolist(), strict=True))
    asked = {key: (part["component_id"].to_numpy(np.int64), _unit(pa.array(list(part["vec"]))),
                   part["id"].to_numpy(np.int64))
             for key, part in asked.groupby(["label", "dim"])}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label, dim = numbers(batch["label"]), numbers(batch["dim"])
            for key, (component, rows, ids) in asked.items():
                part = batch.filter(pa.array((label == key[0]) & (dim == key[1])))
                if part.num_rows:
                    hit = rows @ _unit(part["vec"]).T >= threshold
                    hit &= ids[:, None] != numbers(part["id"])[None, :]
                    same = component[:, None] == numbers(part["component_id"])[None, :]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x) for x in (ids, hit.sum(axis=1), (hit & same).sum(axis=1))],
                        ["id", "links", "found"])

    shares: dict[int, list[float]] = {}
    for r in named.mapInArrow(run, "id long, links long, found long").groupBy("id").agg(
            F.sum("links").alias("links"), F.sum("found").alias("found")).where(
            "links > 0").collect():
        shares.setdefault(grades[r["id"]], []).append(r["found"] / r["links"])
    return min((float(np.mean(x)) for x in shares.values()), default=1.0)


def _count_tile(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in groups(batches, ["component_id", "i", "j"]):
            block, i, j = numbers(tile["block"]), tile["i"][0].as_py(), tile["j"][0].as_py()
            copies, ids = numbers(tile["copies"]), numbers(tile["id"])
            label, rows = numbers(tile["label"]), _unit(tile["vec"])
            left = np.flatnonzero(block == i)
            right = left if i == j else np.flatnonzero(block == j)
            hit = (rows[left] @ rows[right].T >= threshold) & (
                label[left][:, None] == label[right][None, :])
            if i == j:
                np.fill_diagonal(hit, False)
                counts = [(ids[left], hit @ copies[right])]
            else:
                counts = [(ids[left], hit @ copies[right]), (ids[right], hit.T @ copies[left])]
            for who, n in counts:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(who), pa.array(n.astype(np.int64))], ["id", "links"])
    return run


def count_links(nodes: DataFrame, tied: DataFrame, threshold: float) -> DataFrame:
    """(id, links): exact number of vectors linked with a node's, copies of others included."""
    size = tied.groupBy("component_id").agg(F.count(F.lit(1)).alias("size"))
    blocks = F.ceil(F.col("size") / TILE).cast("int")
    rows = (tied.join(size.hint("rebalance"), "component_id").withColumn("blocks", blocks)
            .withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
            .join(nodes, "id"))
    tiles = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda other: F.struct(
        F.least("block", other).alias("i"), F.greatest("block", other).alias("j")))
    key = ["component_id", "i", "j"]
    return (
        rows.select("component_id", "id", "label", "vec", "copies", "block", F.inline(tiles))
        .repartition(*key).sortWithinPartitions(*key)
        .mapInArrow(_count_tile(threshold), "id long, links long")
        .groupBy("id").agg(F.sum("links").alias("links"))
    )


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of (vec_id, embedding, label)."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                          F.col("embedding").cast("array<float>").alias("vec"),
                          F.col("label").cast("int").alias("label"))
    nodes = pin(nodes_of(rows))
    lists = nodes.select("id", F.lit(LIST).alias("k"))
    large = large_labels(nodes, threshold)
    edges = None
    for attempt in range(TRIES):
        found = first_edges(nodes, attempt, threshold, large)
        edges = pin(nearest(found if edges is None else found.union(edges.drop("listed")), lists,
                            threshold))
        for _ in range(ROUNDS):
            graph = edges.where("listed").drop("listed")
            new = improved(graph, nodes, lists, threshold)
            edges = pin(nearest(edges.drop("listed").union(new), lists, threshold))
            graph = edges.where("listed").drop("listed")
            lists = pin(longer_lists(graph, lists, threshold))
        tied = pin(components(edges.where("tie").select("a", "b")))
        tied = with_missing(nodes.join(full_lists(graph, threshold).hint("rebalance"), "id"), tied,
                            threshold)
        if audit(nodes, tied, threshold) >= RECALL:
            break
    else:
        tied = with_missing(nodes, tied, threshold)
    counts = count_links(nodes, tied, threshold)
    named = nodes.join(tied, "id", "left").join(counts, "id", "left").select(
        F.col("label").alias("l"), F.col("vec").alias("v"),
        F.coalesce("component_id", "id").alias("c"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n"))
    joined = rows.join(named.hint("rebalance"), (rows.label == named.l) & (rows.vec == named.v)
                       & rows.vec_id.isNotNull(), "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("c", "vec_id"))
    return joined.select(
        "vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))


# --------------------------------------------------------------------- queries
def op2_vector_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))
