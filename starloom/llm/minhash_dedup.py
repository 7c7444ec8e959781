"""Near-duplicate documents: multi-index Hamming join over b-bit MinHash signatures.

Every document gets ``CHUNKS * WIDTH`` MinHash values of 16 bits. Two documents whose signatures
differ in at most ``CHUNKS * 2 - 1`` values have, by the pigeonhole principle, a chunk that differs
in at most one value. So each chunk is indexed with each of its values left out in turn: two
documents within that distance always share a key. Pairs farther apart mostly share one, too: with
values equal at the rate of the similarity, no chunk of a pair agrees in four of its five values
with a chance of 4e-10 at 0.85 and 1e-7 at 0.80. Pairs that share a key are dropped by their
signatures only beyond six deviations, one in 10^9.

Documents with the same word sequence are one class and take part once. Buckets are not expanded
into all pairs at first: each member is compared with the bucket's smallest member, which ties a
group of copies together however large it is. Only members of a bucket that are still apart are
then compared with each other, in blocks: those outside the bucket's main component with one another
and with that component, each side in as few blocks as its rows and shingles ask for. Of buckets with
the same members one is taken, and a pair is taken from the first key it shares. Pairs whose
sizes or signatures rule the similarity out are dropped; the rest is confirmed on the full shingle
sets. Blocks are confirmed where they meet, and give only the links that tie components together.

Members of a bucket of more than ``LARGE_BUCKET`` are not compared under that bucket's key, of which
each has up to 60. Such buckets with one smallest component make a group, where a document takes part
once. A text is told there by its difference, the shingles that it has beyond or lacks of the usual
ones, those that more than half of the group have. Two texts differ by both differences less twice
what these have in common. So texts near enough to the usual set are linked by that alone, and any
other linked pair shares a least number of differing shingles. By prefix filtering the pair then
meets at one of the rare shingles at the head of both differences, which are the keys instead. The
head is shorter for the one nearer to the usual set, and keys at which no text leads are left out.

Null and empty texts and texts of white space have no shingles, are linked with nothing and kept.
A text of fewer than five words is one shingle. Rows that repeat a doc_id are one document, linked
by any of its texts. Rows without a doc_id cannot be named: component_id is null, kept is true.
Other columns are ignored, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import (
    by_text,
    components,
    groups,
    numbers,
    portions,
    table,
    text_bytes,
)
from starloom.llm.wordhash import mix, sequence_digests, shingles, words
from starloom.session import pin

CHUNKS, WIDTH = 12, 5
N_VALUES = CHUNKS * WIDTH
BLOCK_ROWS, BLOCK_SHINGLES = 512, 1_000_000
LONG_VALUES = 256
LARGE_BUCKET = 64
#: Shingles that one in COMMON texts of a group have are counted; rarer ones come first uncounted.
COMMON = 8
#: The low six bits of keys that are shingles of a difference.
SHINGLE_SLOT = 63
_draw = np.random.default_rng(20)
_N = N_VALUES + LONG_VALUES
FACTORS = _draw.integers(1, 2**63, _N, np.uint64) * np.uint64(2) + np.uint64(1)
TERMS = _draw.integers(0, 2**63, _N, np.uint64)


# ------------------------------------------------------------------ signatures
def signatures(hashes: np.ndarray, first: np.ndarray, draws: range = range(N_VALUES)) -> np.ndarray:
    """16-bit MinHash values, one row per document; documents without shingles get zeros."""
    full = np.diff(first) > 0
    out = np.zeros((len(full), len(draws)), np.uint16)
    if full.any():
        for column, k in enumerate(draws):
            values = (hashes * FACTORS[k] + TERMS[k]) >> np.uint64(16)
            least = np.minimum.reduceat(values, first[:-1][full])
            out[full, column] = (mix(least) & np.uint64(0xFFFF)).astype(np.uint16)
    return out


def _fixed(values: np.ndarray) -> pa.Array:
    """Rows of a matrix as binary values."""
    rows = np.ascontiguousarray(values)
    width = rows.itemsize * rows.shape[1]
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(rows),
                                 [None, pa.py_buffer(offsets), pa.py_buffer(rows)])


def _distinct(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes within each document, and the document's range of them."""
    document = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((hashes, document))
    hashes, document = hashes[order], document[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (document[1:] != document[:-1])
    counts = np.bincount(document[new], minlength=len(first) - 1)
    return hashes[new], np.concatenate([[0], np.cumsum(counts)])


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in portions(batch, by_text):
            found = words(*text_bytes(part["text"]))
            hashes, first = _distinct(*shingles(found, 5))
            digest = sequence_digests(found).view(np.int64)
            empty = pa.array(np.diff(first) == 0)
            none = pa.nulls(part.num_rows, pa.binary())
            sig = pa.compute.if_else(empty, none, _fixed(signatures(hashes, first)))
            yield pa.RecordBatch.from_arrays(
                [part["doc_id"], pa.array(np.diff(first)), pa.array(digest[:, 0].copy()),
                 pa.array(digest[:, 1].copy()), sig],
                ["doc_id", "n_shingles", "digest_a", "digest_b", "sig"])


def sign(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, digest_a, digest_b, sig) of every row; ``sig`` is null without words."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _signed, "doc_id long, n_shingles long, digest_a long, digest_b long, sig binary")


# ------------------------------------------------------------------------ keys
def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A key per chunk and value left out of it; its low six bits tell which."""
    for batch in batches:
        sig = _matrix(batch["sig"])
        ids = batch["id"]
        for chunk in range(CHUNKS):
            values = sig[:, chunk * WIDTH:(chunk + 1) * WIDTH].astype(np.uint64)
            for left_out in range(WIDTH):
                slot = np.uint64(chunk * WIDTH + left_out)
                key = np.full(len(sig), slot, np.uint64)
                for k in range(WIDTH):
                    if k != left_out:
                        key = mix(key * np.uint64(65537) + values[:, k] + np.uint64(1))
                key = (key << np.uint64(6)) | slot
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), ids], ["key", "id"])


def _matrix(column: pa.Array, width: int = N_VALUES) -> np.ndarray:
    data = np.frombuffer(b"".join(column.to_pylist()), np.uint16)
    return data.reshape(len(column), width)


def _first_slot(same: np.ndarray) -> np.ndarray:
    """The first slot at which signatures meet, from where their values are the same."""
    same = same.reshape(-1, CHUNKS, WIDTH)
    chunk = np.argmax(same.sum(axis=2) >= WIDTH - 1, axis=1)
    return chunk * WIDTH + np.argmin(same[np.arange(len(same)), chunk], axis=1)


def _near(width: int, most: int, percent: int):
    """Pairs whose sizes allow the similarity and whose signatures are within the distance."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            apart = (_matrix(batch["sig_a"], width) != _matrix(batch["sig_b"], width)).sum(axis=1)
            n_a, n_b = numbers(batch["n_a"]), numbers(batch["n_b"])
            size = 100 * np.minimum(n_a, n_b) >= percent * np.maximum(n_a, n_b)
            yield batch.select(["a", "b"]).filter(pa.array((apart <= most) & size))
    return run


def near(pairs: DataFrame, signed: DataFrame, width: int, most: int, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose ``signed`` (id, n, sig) are near each other."""
    side = lambda x: signed.select(
        F.col("id").alias(x), F.col("n").alias(f"n_{x}"), F.col("sig").alias(f"sig_{x}"))
    return pairs.join(side("b"), "b").join(side("a"), "a").mapInArrow(
        _near(width, most, percent), "a long, b long")


def farthest(n_values: int, percent: int) -> int:
    """Six deviations above the mean number of differing values at the similarity asked for."""
    apart = 1 - percent / 100
    return round(n_values * apart + 6 * (n_values * apart * (1 - apart)) ** 0.5)


def _linked_in_blocks(percent: int):
    """Links within each (key, i, j) that tie its components together, at most one per row.

    Tile (-1 - i, j) holds others of block i and members of the bucket's main component (those whose
    key does not lead) of block j; tile (i, j) holds others of two blocks. A pair is compared at the first key it shares (at each if
    these are shingles of differences), by its signatures, then on the full sets: one text's shingles are marked in a table of the tile's, and
    the marks under its partners' shingles add up to the intersections.
    """
    most = farthest(N_VALUES, percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in groups(batches, ["key", "i", "j"]):
            i, j = tile["i"][0].as_py(), tile["j"][0].as_py()
            slot = tile["key"][0].as_py() & 63
            ids, block, main = (numbers(tile[c]) for c in ("id", "block", "main"))
            label = numbers(tile["component_id"]).copy()
            sig = _matrix(tile["sig"].combine_chunks())
            sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in tile["shingles"]]
            n = np.array([len(x) for x in sets])
            number = mark = None
            left = np.flatnonzero(main == 0 if i < 0 else block == i)
            right = np.flatnonzero(main == 1 if i < 0 else block == j)
            links = []
            for x in left:
                y = right if i != j else right[ids[right] > ids[x]]
                y = y[(label[y] != label[x])
                      & (100 * np.minimum(n[y], n[x]) >= percent * np.maximum(n[y], n[x]))]
                same = sig[y] == sig[x]
                close = (~same).sum(axis=1) <= most
                if slot != SHINGLE_SLOT:
                    close[close] = _first_slot(same[close]) == slot
                y = y[close]
                if not len(y):
                    continue
                if number is None:
                    known, flat = np.unique(np.concatenate(sets), return_inverse=True)
                    number, mark = np.split(flat, np.cumsum(n)[:-1]), np.zeros(len(known), bool)
                mark[number[x]] = True
                shared = np.array([np.count_nonzero(mark[number[k]]) for k in y])
                mark[number[x]] = False
                for k in y[100 * shared >= percent * (n[x] + n[y] - shared)]:
                    if label[k] != label[x]:
                        label[label == label[k]] = label[x]
                        links.append((min(ids[x], ids[k]), max(ids[x], ids[k])))
            if links:
                a, b = np.array(links, np.int64).T.copy()
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])
    return run


# ---------------------------------------------------------------- confirmation
def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in portions(batch, by_text):
            hashes, first = _distinct(*shingles(words(*text_bytes(part["text"])), 5))
            raw = [hashes[s:e].tobytes() for s, e in zip(first[:-1], first[1:], strict=True)]
            sig = _fixed(signatures(hashes, first, range(N_VALUES, _N)))
            yield pa.RecordBatch.from_arrays(
                [part["doc_id"], pa.array(np.diff(first)), sig, pa.array(raw, pa.binary())],
                ["id", "n", "sig", "shingles"])


def _confirmed(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch["set_a"], batch["set_b"], strict=True):
                a = np.frombuffer(a.as_buffer(), np.uint64)
                b = np.frombuffer(b.as_buffer(), np.uint64)
                both = np.concatenate([a, b])
                both.sort()
                shared = int((both[1:] == both[:-1]).sum())
                keep.append(100 * shared >= percent * (len(both) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def shingle_sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, n, sig, shingles) of the texts of ``ids`` (id), written down.

    The texts are dealt out by id at every size of ``ids``: a broadcast would only do while the ids
    are few.
    """
    ids = ids.distinct().withColumnRenamed("id", "doc_id").hint("shuffle_hash")
    return pin(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
               .join(ids, "doc_id", "left_semi")
               .mapInArrow(_sets, "id long, n long, sig binary, shingles binary"))


def confirm(sets: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) with ``100 * intersection >= percent * union`` of their shingles."""
    likely = pin(near(pairs, sets, LONG_VALUES, farthest(LONG_VALUES, percent), percent))
    side = lambda x: sets.select(
        F.col("id").alias(x), F.col("shingles").alias(f"set_{x}"))
    return likely.join(side("b"), "b").join(side("a"), "a").select("a", "b", "set_a", "set_b") \
        .mapInArrow(_confirmed(percent), "a long, b long").distinct()


# ----------------------------------------------------------------- differences
def _common(texts: pa.Table) -> pa.Table:
    """How many texts of a part of a group have a shingle, of those that one in COMMON have.

    Rarer ones are left out of a part's count. That sways which shingles count as usual and in
    which order they come, not which pairs are linked: these follow for any usual set and order.
    """
    sets = [np.frombuffer(x.as_buffer(), np.int64) for x in texts["shingles"]]
    shingle, found = np.unique(np.concatenate(sets), return_counts=True)
    often = found * COMMON >= len(sets)
    return pa.Table.from_arrays(
        [pa.array(np.full(often.sum(), texts["group"][0].as_py(), np.int64)),
         pa.array(shingle[often]), pa.array(found[often].astype(np.int64))],
        ["group", "shingle", "found"])


_DIFFERENCE = pa.schema([
    ("group", pa.int64()), ("id", pa.int64()), ("component_id", pa.int64()),
    ("n_usual", pa.int64()), ("excess", pa.int64()), ("difference", pa.binary())])


def _differences(percent: int):
    """Each text's difference from the usual shingles of its group, rare shingles first.

    ``excess`` is ``(100 + percent) * size of the difference - (100 - percent) * n``. Two texts are
    linked when their excesses add up to at most ``2 * (100 + percent)`` times the shingles that
    their differences have in common.
    """
    def run(texts: pa.Table, common: pa.Table) -> pa.Table:
        # One place more than there are shingles, for those beyond the last.
        shingle = np.append(numbers(common["shingle"]), np.iinfo(np.int64).max)
        order = np.argsort(shingle, kind="stable")
        shingle = shingle[order]
        found = np.append(numbers(common["found"]), 0)[order]
        size = np.append(numbers(common["size"]), 0)[order]
        usual = 2 * found > size
        n_usual = int(usual.sum())
        excess, difference = [], []
        for x in texts["shingles"]:
            own = np.frombuffer(x.as_buffer(), np.int64)
            place = np.searchsorted(shingle, own)
            known = shingle[place] == own
            lacks = usual.copy()
            lacks[place[known]] = False
            beyond = ~(known & usual[place])
            often = np.concatenate([np.where(known, found[place], 0)[beyond], (size - found)[lacks]])
            differing = np.concatenate([own[beyond], shingle[lacks]])
            difference.append(differing[np.lexsort((differing, often))].tobytes())
            excess.append((100 + percent) * len(differing) - (100 - percent) * len(own))
        columns = [texts[c].combine_chunks() for c in ("group", "id", "component_id")]
        return pa.Table.from_arrays(
            [*columns, pa.array([n_usual] * len(excess), pa.int64()), pa.array(excess, pa.int64()),
             pa.array(difference, pa.binary())], schema=_DIFFERENCE)
    return run


def _heads(percent: int):
    """A key for each shingle at the head of a difference at which a link of the text must show.

    Texts whose excess and the ``least`` of the group are together at most 0 are linked with the
    text of the least; the partners that are left to them have an excess above ``-least``. A key
    leads where the text can meet partners whose excess is no smaller than its own. Each pair has
    such a text, so texts whose key does not lead need not be compared with each other.
    """
    part = 2 * (100 + percent)
    by_difference = lambda rows: numbers(
        pa.compute.binary_length(rows["difference"])).astype(np.int64) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in portions(whole, by_difference)):
            keys, sizes, leads = [], [], []
            group = mix(numbers(batch["group"]).astype(np.uint64))
            for k, x in enumerate(batch["difference"]):
                differing = np.frombuffer(x.as_buffer(), np.uint64)
                excess, least = batch["excess"][k].as_py(), batch["least"][k].as_py()
                if excess + least <= 0:
                    larger = any_partner = -((least - excess - 1) // part)
                else:
                    beyond = excess - (100 - percent) * batch["n_usual"][k].as_py()
                    any_partner = max(-(-(excess + least) // part), -(-beyond // 200))
                    larger = max(any_partner, -(-2 * excess // part))
                head = differing[:max(0, len(differing) - max(1, any_partner) + 1)]
                key = mix(head ^ group[k]) << np.uint64(6) | np.uint64(SHINGLE_SLOT)
                keys.append(key.view(np.int64))
                leads.append(np.arange(len(head)) <= len(differing) - max(1, larger))
                sizes.append(len(head))
            if sum(sizes):
                at = pa.array(np.repeat(np.arange(len(sizes)), sizes))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys)), batch["id"].take(at),
                     batch["component_id"].take(at), pa.array(np.concatenate(leads))],
                    ["key", "id", "component_id", "leads"])
    return run


def by_differences(members: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) and places (key, id, component_id, leads) of ``members`` (group, id, component_id).

    All linked pairs of a group are tied by the links or share a key that leads for one of them.
    """
    held = pin(members.join(sets.select("id", "n", "shingles"), "id"))
    parts = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS), F.ceil(F.sum("n") / BLOCK_SHINGLES))
    sizes = pin(held.groupBy("group").agg(F.count(F.lit(1)).alias("size"),
                                          parts.cast("int").alias("parts")))
    texts = held.join(sizes.select("group", "parts").hint("rebalance"), "group").withColumn(
        "part", F.pmod(F.xxhash64("id"), "parts").cast("int"))
    # At most COMMON times the shingles of an average text of the group.
    common = texts.select("group", "part", "shingles").groupBy("group", "part").applyInArrow(
        _common, "group long, shingle long, found long").groupBy("group", "shingle").agg(
            F.sum("found").alias("found")).join(sizes.hint("rebalance"), "group").where(
                F.col("found") * COMMON >= F.col("size"))
    common = common.select("group", "shingle", "found", "size", F.explode(
        F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    texts = texts.select("group", "part", "id", "component_id", "shingles")
    differing = pin(texts.groupBy("group", "part").cogroup(common.groupBy("group", "part"))
                    .applyInArrow(_differences(percent),
                                  "group long, id long, component_id long, n_usual long, "
                                  "excess long, difference binary"))
    least = differing.groupBy("group").agg(F.min("excess").alias("least"),
                                           F.min_by("id", "excess").alias("nearest"))
    differing = differing.join(least.hint("rebalance"), "group")
    links = differing.where("excess + least <= 0 and id <> nearest").select(
        F.least("id", "nearest").alias("a"), F.greatest("id", "nearest").alias("b"))
    return pin(links), pin(differing.mapInArrow(
        _heads(percent), "key long, id long, component_id long, leads boolean").distinct())


# ------------------------------------------------------------------------ join
def mixed(places: DataFrame) -> DataFrame:
    """Buckets whose members are still apart, with the marks by which equal ones are known."""
    mark = F.xxhash64("id", "leads")
    return places.groupBy("key").agg(
        F.min("component_id").alias("low"), F.max("component_id").alias("high"),
        F.min_by("component_id", "id").alias("main_component"), F.count(F.lit(1)).alias("n"),
        F.sum(mark.bitwiseAND(F.lit(0xFFFFFFFF))).alias("mark_a"),
        F.sum(F.shiftrightunsigned(mark, 32)).alias("mark_b"),
        F.bool_or("leads").alias("leads")).where("low <> high and leads").drop("leads")


def to_compare(apart: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) and, of the places (key, id, component_id), those (with ``main``) to compare."""
    apart = apart.withColumn("leads", F.lit(True))
    buckets = pin(mixed(apart))
    large = buckets.where(F.col("n") > LARGE_BUCKET).select(
        "key", F.col("low").alias("group"))
    links, finer = by_differences(apart.join(large.hint("rebalance"), "key").select(
        "group", "id", "component_id").distinct(), sets, percent)
    # Of buckets with the same members the one with the first slot stays, where their pairs meet.
    slot = F.col("key").bitwiseAND(F.lit(63))
    once = buckets.where(F.col("n") <= LARGE_BUCKET).unionByName(mixed(finer)).groupBy(
        "n", "mark_a", "mark_b", slot == SHINGLE_SLOT).agg(
            F.min_by(F.struct("key", "main_component"), slot).alias("kept"))
    main = F.when(slot == SHINGLE_SLOT, ~F.col("leads")).otherwise(
        F.col("component_id") == F.col("main_component"))
    return links, apart.unionByName(finer).join(
        once.select("kept.*").hint("rebalance"), "key").select(
            "key", "id", "component_id", main.cast("int").alias("main"))


def near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs`` (doc_id, text).

    Documents are linked when their sets of five-word shingles have ``100 * intersection >=
    percent * union``; a component is a set of documents tied by links, named by its smallest id.
    """
    signed = pin(sign(docs))
    digest = ["digest_a", "digest_b"]
    named = signed.where("sig is not null and doc_id is not null")
    classes = pin(named.groupBy(*digest).agg(
        F.min("doc_id").alias("id"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig")))
    same_id = named.select("doc_id", *digest).join(classes.select(*digest, "id").hint("rebalance"),
                                                   digest)
    own = same_id.where("doc_id <> id").groupBy("doc_id", "id").agg(F.count(F.lit(1)))
    own = own.select(F.col("id").alias("a"), F.col("doc_id").alias("b"))

    keys = classes.select("id", "sig").mapInArrow(_keys, "key long, id long")
    shared = pin(keys.groupBy("key").agg(F.min("id").alias("head"), F.max("id").alias("last"),
                                         F.count(F.lit(1)).alias("members"))
                 .where("head <> last").select("key", "head", "members"))
    members = pin(keys.join(shared, "key"))

    signs = classes.select("id", "n", "sig")
    stars = members.where("id <> head").select(F.col("head").alias("a"), F.col("id").alias("b"))
    pairs = near(stars.distinct(), signs, N_VALUES, farthest(N_VALUES, percent), percent)
    sets = shingle_sets(docs, members.select("id"))
    links = pin(confirm(sets, pin(pairs), percent))
    tied = components(links)

    apart = pin(members.where("members > 2").join(tied, "id", "left").select(
        "key", "id", F.coalesce("component_id", "id").alias("component_id")))
    nearest, places = to_compare(apart, sets, percent)
    rows = pin(places.join(signs, "id"))

    def blocks(main: int, name: str) -> Column:
        mine = F.col("main") == main
        return F.greatest(F.lit(1), F.ceil(F.count_if(mine) / BLOCK_ROWS), F.ceil(
            F.sum(F.when(mine, F.col("n")).otherwise(0)) / BLOCK_SHINGLES)).cast("int").alias(name)
    sizes = rows.groupBy("key").agg(blocks(1, "main_blocks"), blocks(0, "other_blocks"))
    own_blocks = F.when(F.col("main") == 1, F.col("main_blocks")).otherwise(F.col("other_blocks"))
    rows = pin(rows.join(sizes.hint("rebalance"), "key").withColumn(
        "block", F.pmod(F.xxhash64("id"), own_blocks).cast("int")))
    # Two blocks meet in a tile; members of the main component meet the others only.
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    tile = lambda i, j: F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"))
    tiles = F.when(F.col("main") == 1, F.transform(
        every("other_blocks"), lambda other: tile(-1 - other, F.col("block")))).otherwise(F.concat(
            F.transform(every("main_blocks"), lambda main: tile(-1 - F.col("block"), main)),
            F.transform(every("other_blocks"), lambda other: tile(
                F.least("block", other), F.greatest("block", other)))))
    later = (rows.select("key", "id", "component_id", "main", "block", "sig", F.inline(tiles))
             .join(sets.select("id", "shingles"), "id")
             .select("key", "i", "j", "id", "component_id", "main", "block", "sig", "shingles")
             .repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
             .mapInArrow(_linked_in_blocks(percent), "a long, b long").distinct())
    tied = pin(components(links.union(nearest).union(later).union(own)))

    named_classes = classes.join(tied, "id", "left").select(
        *digest, F.coalesce("component_id", "id").alias("class_component"))
    found = signed.join(named_classes.hint("rebalance"), digest, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("class_component", "doc_id"))
    return found.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


# --------------------------------------------------------------------- queries
def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), 85)
