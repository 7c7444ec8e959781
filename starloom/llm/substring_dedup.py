"""Substring dedup: relative Lempel-Ziv factors of every document against indexed reference blocks.

A text is cut into blocks where its content says so. Of the ``GRAM``-word runs inside each window of
``WINDOW`` words the one with the least hash, the leftmost of equals, is the window's seed; windows
next to each other with the same seed occurrence make one block, so each window lies in exactly one
block and equal stretches of text are cut alike wherever they stand. The first place of each
distinct block, by (doc_id, text, word), is a reference block; the index of them is a table keyed by
the block's hash.

A document is factored from left to right: a block that the index has at an earlier place starts a
factor, which grows as long as the next blocks are found further on at the same source. Factors
have ``WINDOW`` words at least. At the boundaries of factors, where a block is not found as a whole,
its windows are checked one by one, against the windows of all reference blocks with the same seed;
that is needed once for each distinct block whose seed other blocks share. Every window that stands
at an earlier place in the corpus is so covered by a factor or found at a boundary, and no other is.
Covered words are removed. All windows are judged on the input.

Blocks move as hashes of 92 bits, a row for some eight words; windows as hashes of 128 bits, only at
boundaries. Texts move to join the boundaries and the factors of their own document.

Null and empty texts have no words. Texts of fewer than ``WINDOW`` words have no window and are kept
whole. A null doc_id comes before all others; rows with the same doc_id and text are one document,
treated alike and no repetition of each other; rows that share only the doc_id come in the order of
a hash of their text. Texts are taken whole, very long ones too. All columns pass through
``drop_duplicate_spans``; names cannot clash. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import by_text, numbers, portions, table, text_bytes
from starloom.llm.wordhash import Words, _power_table, mix, words
from starloom.session import pin

WINDOW = 20
GRAM = 6
#: Seeds a window can choose from.
CHOICES = WINDOW - GRAM + 1
#: Texts are compared as they are.
AS_IS = np.arange(256, dtype=np.uint8)
SPAN_BITS = 4
SALT = np.uint64(0x2545F4914F6CDD1D)
SPAN = "struct<start:long,size:long,ref_doc:long,ref_start:long>"
FACTORS = f"n_words long, n_removed long, kept string, factors array<{SPAN}>"


# ---------------------------------------------------------------------- hashing
def _run_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` words of the whole batch, wherever documents end."""
    power = _power_table(max(len(hashes), width))[0]
    out = np.zeros(max(len(hashes) - width + 1, 0), np.uint64)
    for k in range(width):
        out += hashes[k:k + len(out)] * power[k + 1]
    return mix(out)


def _stretch_hashes(hashes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each stretch [start, end) of the words of a batch, from one running sum."""
    power, unpower = _power_table(len(hashes) + 1)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * power[:len(hashes)], out=sums[1:])
    return mix((sums[end] - sums[start]) * unpower[start] + (end - start).astype(np.uint64) * SALT)


def _windows(found: Words) -> tuple[np.ndarray, np.ndarray]:
    """(first word in the batch, document) of every window."""
    count = np.maximum(np.diff(found.first) - WINDOW + 1, 0)
    document = np.repeat(np.arange(len(count)), count)
    before = np.cumsum(count) - count
    return found.first[document] + np.arange(len(document)) - before[document], document


def cut(found: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, first window, number of windows, seed) of each block; places within the batch."""
    start, document = _windows(found)
    if not len(start):
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(np.uint64)
    grams = _run_hashes(found.hashes(), GRAM)
    least, seed_at = grams[start], start.copy()
    for k in range(1, CHOICES):
        value = grams[start + k]
        lower = value < least
        least[lower], seed_at[lower] = value[lower], (start + k)[lower]
    new = np.ones(len(start), bool)
    new[1:] = (seed_at[1:] != seed_at[:-1]) | (document[1:] != document[:-1])
    first = np.flatnonzero(new)
    return (document[first], start[first], np.diff(np.append(first, len(start))), least[first])


def _words(part: pa.RecordBatch) -> Words:
    return words(*text_bytes(part["text"]), case=AS_IS)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in portions(batch, by_text):
            found = _words(part)
            document, start, n, seed = cut(found)
            hashes, end = found.hashes(), start + n + WINDOW - 1
            check = _stretch_hashes(mix(hashes + SALT), start, end) << np.uint64(SPAN_BITS)
            # The seed's place within the block is part of it, by its hash and the words around it.
            check = ((check | n.astype(np.uint64)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            tag = numbers(part["tag"])[document].astype(np.int64) << 32
            yield pa.RecordBatch.from_arrays(
                [pa.array(seed.view(np.int64)),
                 pa.array(_stretch_hashes(hashes, start, end).view(np.int64)),
                 pa.array(check.view(np.int32)),
                 part["doc_id"].take(pa.array(document)),
                 pa.array(tag | (start - found.first[document]))],
                ["seed", "block", "check", "doc_id", "place"])


def _boundary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(window_a, window_b, doc_id, place) of the windows of the blocks in ``blocks``."""
    for batch in batches:
        for part in portions(batch, by_text):
            found = _words(part)
            hashes = found.hashes()
            lists = part["blocks"]
            size = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten()
            n = numbers(flat.field("n")).astype(np.int64)
            document = np.repeat(np.repeat(np.arange(len(size)), size), n)
            first = np.repeat(numbers(flat.field("start")), n)
            start = first + np.arange(len(first)) - np.repeat(np.cumsum(n) - n, n)
            at = found.first[document] + start
            tag = numbers(part["tag"])[document].astype(np.int64) << 32
            yield pa.RecordBatch.from_arrays(
                [pa.array(_stretch_hashes(h, at, at + WINDOW).view(np.int64))
                 for h in (hashes, mix(hashes + SALT))]
                + [part["doc_id"].take(pa.array(document)), pa.array(tag | start)],
                ["window_a", "window_b", "doc_id", "place"])


# --------------------------------------------------------------------- factoring
def _start(place: Column) -> Column:
    return place.bitwiseAND(0xFFFFFFFF)


def _tag(place: Column) -> Column:
    return F.shiftright(place, 32).cast("int")


def _n_windows(check: Column) -> Column:
    return check.bitwiseAND(2 ** SPAN_BITS - 1).cast("long")


def _tagged(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.xxhash64("text").bitwiseAND(0x7FFFFFFF).cast("int").alias("tag"), "text")


def _same_row(a: DataFrame, b: DataFrame) -> Column:
    return a["doc_id"].eqNullSafe(b["doc"]) & (a["tag"] == b["mark"])


def earlier_places(docs: DataFrame) -> DataFrame:
    """(doc, mark, spans) per text that repeats something: what stands at an earlier place."""
    texts = _tagged(docs)
    blocks = texts.mapInArrow(
        _blocks, "seed long, block long, check int, doc_id long, place long")
    repeated = pin(blocks.groupBy("seed").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                   .select("seed"))
    shared = pin(blocks.join(repeated, "seed", "left_semi"))
    key, here = ["seed", "block", "check"], F.struct("doc_id", "place")
    index = pin(shared.groupBy(*key).agg(F.min(here).alias("first"), F.count(F.lit(1)).alias("n")))
    found = index.where("n > 1").select(*key, "first")
    whole = shared.join(found, key).where(~here.eqNullSafe(F.col("first"))).select(
        "doc_id", "place", (_n_windows(F.col("check")) + WINDOW - 1).alias("size"), "first")

    contested = index.groupBy("seed").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    ends = index.join(pin(contested.select("seed")), "seed", "left_semi").groupBy(
        F.col("first.doc_id").alias("doc"), _tag(F.col("first.place")).alias("mark")).agg(
        F.collect_list(F.struct(_start(F.col("first.place")).alias("start"),
                                _n_windows(F.col("check")).alias("n"))).alias("blocks"))
    windows = pin(texts.join(ends.hint("rebalance"), _same_row(texts, ends)).select(
        "doc_id", "tag", "text", "blocks").mapInArrow(
        _boundary, "window_a long, window_b long, doc_id long, place long"))
    key = ["window_a", "window_b"]
    found = pin(windows.groupBy(*key).agg(
        F.min(here).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    single = windows.join(found, key).where(~here.eqNullSafe(F.col("first"))).select(
        "doc_id", "place", F.lit(WINDOW).cast("long").alias("size"), "first")
    return whole.union(single).groupBy(
        F.col("doc_id").alias("doc"), _tag(F.col("place")).alias("mark")).agg(
        F.collect_set(F.struct(
            _start(F.col("place")).alias("start"), "size", F.col("first.doc_id").alias("ref_doc"),
            _start(F.col("first.place")).alias("ref_start"))).alias("spans"))


def parse(spans: list[dict]) -> list[dict]:
    """Greedy factors from what was found: a factor grows while its source goes on."""
    out: list[dict] = []
    for span in sorted(spans, key=lambda s: (s["start"], -s["size"])):
        last = out[-1] if out else None
        if (last and span["start"] <= last["start"] + last["size"]
                and span["ref_doc"] == last["ref_doc"]
                and span["ref_start"] - last["ref_start"] == span["start"] - last["start"]):
            last["size"] = max(last["size"], span["start"] + span["size"] - last["start"])
        elif not last or span["start"] + span["size"] > last["start"] + last["size"]:
            out.append(dict(span))
    return out


def _factored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in portions(batch, by_text):
            rows = []
            for text, spans in zip(part["text"], part["spans"], strict=True):
                told = (text.as_py() or "").encode().split()
                factors = parse(spans.as_py() or [])
                kept, at = [], 0
                for factor in factors:
                    kept += told[at:factor["start"]]
                    at = max(at, factor["start"] + factor["size"])
                kept += told[at:]
                rows.append((len(told), len(told) - len(kept), b" ".join(kept).decode(), factors))
            yield pa.RecordBatch.from_arrays(
                [part["row"], pa.array([r[0] for r in rows], pa.int64()),
                 pa.array([r[1] for r in rows], pa.int64()),
                 pa.array([r[2] for r in rows], pa.large_string()).cast(pa.string()),
                 pa.array([r[3] for r in rows], pa.list_(pa.struct([
                     (k, pa.int64()) for k in ("start", "size", "ref_doc", "ref_start")])))],
                ["row", "n_words", "n_removed", "kept", "factors"])


def with_factors(docs: DataFrame) -> DataFrame:
    """(row, n_words, n_removed, kept, factors): every row as a struct, with its parse.

    ``kept`` holds the words that stay, joined by one blank; ``factors`` are the stretches found at
    an earlier place, as (start, size, ref_doc, ref_start) in words.
    """
    spans = earlier_places(docs.select("doc_id", "text"))
    rows = docs.select(
        F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").bitwiseAND(0x7FFFFFFF).cast("int").alias("tag"))
    row = rows.schema["row"].dataType.simpleString()
    return rows.join(spans, _same_row(rows, spans), "left").select(
        "row", F.col("row.text").alias("text"), "spans").mapInArrow(
        _factored, f"row {row}, {FACTORS}")


def drop_duplicate_spans(docs: DataFrame) -> DataFrame:
    """``docs`` with the columns it came with; texts that lose words hold the kept ones only."""
    new = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("row.text"))
    return with_factors(docs).select(*[
        (new if c == "text" else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


# ----------------------------------------------------------------------- queries
def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return with_factors(docs).select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "n_removed",
        F.sha2("kept", 256).alias("kept_sha256"))


OP11_SQL = r"""
with texts as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents
), windows as (
  select doc_id, i as start, array_to_string(ws[i + 1:i + 20], ' ') as run
  from texts, range(0, len(ws) - 19) r(i)
), numbered as (
  select doc_id, start, row_number() over (partition by run order by doc_id, start) as occurrence
  from windows
), covered as (
  select distinct doc_id, start + k as place from numbered, range(0, 20) s(k) where occurrence > 1
), split as (
  select doc_id, i as place, ws[i + 1] as word from texts, range(0, len(ws)) r(i)
), kept as (
  select s.doc_id, string_agg(s.word, ' ' order by s.place) as text, count(*) as n
  from split s anti join covered c on s.doc_id = c.doc_id and s.place = c.place group by s.doc_id
)
select t.doc_id, len(t.ws)::bigint as n_words,
  (len(t.ws) - coalesce(k.n, 0))::bigint as n_removed, sha256(coalesce(k.text, '')) as kept_sha256
from texts t left join kept k on t.doc_id = k.doc_id
"""
