"""Best-fit packing into sequences of several permitted lengths.

Documents are taken as they lie in their partition, in lots of about ``LOT_TOKENS`` tokens, so no
row moves and memory is bounded however large a partition is. Within a lot, longest first, each
piece goes into the open sequence that it leaves least room in. When none fits, a sequence is opened
of the length with the least cost per token among those that hold the piece and are not below a
least length; the lot is packed once for each permitted least length and the cheapest packing
stands. At last every sequence is cut down to the shortest permitted length that holds what it got.

Documents longer than the longest sequence are cut at words into pieces of that length. Tokens are
words; null and empty texts and texts without words are one piece of no tokens, so every row is in
the result. Rows that repeat a doc_id are packed one by one, a null doc_id stays null. Other columns
are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import SPACES, table, word_count

LENGTHS = (256, 512, 1024, 2048, 4096)
LOT_TOKENS = 2_000_000
SEQUENCE_COST, ATTENTION = 24, 1 / 16384
_WORD = re.compile(f"[^{SPACES}]+")
SCHEMA = ("bin_id long, capacity long, used long, start long, doc_id long, piece long, "
          "n_tokens long, text string")


def cost(length: int) -> float:
    """Of training on one sequence: a fixed part, its tokens, and attention among them."""
    return SEQUENCE_COST + length + ATTENTION * length * length


@dataclass
class Bin:
    capacity: int
    used: int
    items: list[int]


def pack(sizes: Sequence[int], lengths: Sequence[int], least: int) -> list[Bin]:
    """Best-fit decreasing; opened sequences are not shorter than ``least``."""
    opens = {}
    rooms: dict[int, list[Bin]] = {}  # open sequences by the room they have left
    mask = 0  # bit r: some sequence has r tokens left
    bins = []
    for i in sorted(range(len(sizes)), key=lambda k: (-sizes[k], k)):
        size = sizes[i]
        fitting = mask >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            here = rooms[room]
            chosen = here.pop()
            if not here:
                mask ^= 1 << room
        else:
            if size not in opens:
                opens[size] = min((c for c in lengths if c >= max(size, least)),
                                  key=lambda c: (cost(c) / c, c))
            chosen = Bin(opens[size], 0, [])
            bins.append(chosen)
        chosen.items.append(i)
        chosen.used += size
        room = chosen.capacity - chosen.used
        rooms.setdefault(room, []).append(chosen)
        mask |= 1 << room
    for b in bins:
        b.capacity = min(c for c in lengths if c >= b.used)
    return bins


def cheapest(sizes: Sequence[int], lengths: Sequence[int]) -> list[Bin]:
    """The packing of least cost over all permitted least lengths."""
    tried = [pack(sizes, lengths, least) for least in lengths]
    return min(tried, key=lambda bins: sum(cost(b.capacity) for b in bins))


def pieces(text: str, n_tokens: int, longest: int) -> list[tuple[int, str]]:
    """(tokens, text) of the document cut before every ``longest``-th word."""
    if n_tokens <= longest:
        return [(n_tokens, text)]
    cuts = [m.start() for k, m in enumerate(_WORD.finditer(text)) if k % longest == 0]
    cuts = [0, *cuts[1:], len(text)]
    last = len(cuts) - 2
    return [(longest if k < last else n_tokens - last * longest, text[cuts[k]:cuts[k + 1]])
            for k in range(last + 1)]


def pack_documents(docs: DataFrame, lengths: Sequence[int] = LENGTHS,
                   lot_tokens: int = LOT_TOKENS) -> DataFrame:
    """One row per piece with its sequence, place and text, for ``docs`` (doc_id, text)."""
    lengths = sorted(lengths)

    def packed(lot: list[tuple], first: int) -> tuple[list[pa.RecordBatch], int]:
        out = {c: [] for c in ("bin_id", "capacity", "used", "start", "item")}
        bins = cheapest([item[2] for item in lot], lengths)
        for number, b in enumerate(bins, first):
            start = 0
            for i in b.items:
                for c, v in zip(out, (number, b.capacity, b.used, start, i), strict=True):
                    out[c].append(v)
                start += lot[i][2]
        rows = [lot[i] for i in out.pop("item")]
        columns = [pa.array(v, pa.int64()) for v in out.values()] + [
            pa.array([r[k] for r in rows], t)
            for k, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string()))]
        batch = pa.RecordBatch.from_arrays(
            columns, [*out, "doc_id", "piece", "n_tokens", "text"])
        return batch, first + len(bins)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        lot, tokens = [], 0
        for batch in batches:
            for doc_id, text, n in zip(*(batch[c].to_pylist() for c in
                                         ("doc_id", "text", "n_tokens")), strict=True):
                for k, (size, part) in enumerate(pieces(text or "", n, lengths[-1])):
                    lot.append((doc_id, k, size, part))
                    tokens += size + 1
                    if tokens >= lot_tokens:
                        out, number = packed(lot, number)
                        yield out
                        lot, tokens = [], 0
        if lot:
            yield packed(lot, number)[0]

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                       word_count(F.col("text")).alias("n_tokens")).mapInArrow(run, SCHEMA)


# --------------------------------------------------------------------- queries
def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents")).drop("text")
