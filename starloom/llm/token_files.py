"""Token ids as Arrow files of equal-length sequences with masks.

A file is an Arrow IPC file of record batches with two fixed-size-list columns: ``ids`` (unsigned
16-bit, or 32-bit for larger vocabularies) and ``mask`` (bits; false is padding after the last id of
the file). Buffers are uncompressed, so a reader maps the file and gets any sequence without copying.
Beside it stands a file of (doc_id, n_tokens) in the same order, which tells where documents lie.

Documents are range-partitioned and sorted by id; a partition writes one pair of files, sequence by
sequence, and never holds more than a batch. Files are written under a name of the attempt and then
renamed, so a repeated task replaces its file as a whole. They go to the shared folder through
pyarrow's file systems.

Words are tokenised once per batch: texts are split at blanks and line feeds, where the tokenizer splits too,
the distinct pieces are encoded by the tokenizers library and their ids gathered. A null or empty
text has the end id alone. A null doc_id sorts first; rows that repeat a doc_id follow each other in
the order of their texts' hashes. Other columns are ignored.
"""

from __future__ import annotations

import os
import unicodedata
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from starloom.llm.common import by_text, portions, table, text_bytes
from starloom.session import pin, shared_folder

END_ID = 1
SEQUENCE, ROWS = 1024, 1024
KNOWN_WORDS, PORTION = 1_000_000, 16_000_000
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a task per core already
#: Letters that composing and lower-casing turn into a letter and a mark, which keeps a full stop with it.
MARKED = "".join(c for c in map(chr, range(128, 0x30000)) if unicodedata.category(c)[0] == "L"
                 and unicodedata.category(unicodedata.normalize("NFC", c).lower()[-1])[0] != "L")
FULL_STOP = rf"([^\P{{L}}{MARKED}])([.,]+)(\s|$)"
_encoders: dict[str, Encoder] = {}


class Encoder:
    """Ids of texts; keeps the ids of up to ``KNOWN_WORDS`` pieces seen before."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.uint16 if self.tokenizer.get_vocab_size() <= 2**16 else np.uint32
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.ends = [np.zeros(0, self.dtype)], [np.zeros(1, np.int64)]

    def _numbers(self, words: list[str]) -> np.ndarray:
        """The number of each piece; new ones are encoded, some 200 at a time."""
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > KNOWN_WORDS:
            self.forget()
            new = words
        for start in range(0, len(new), 200):
            part = new[start:start + 200]
            found = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            # A token belongs to the piece in which it starts.
            size = np.fromiter(map(len, part), np.int64, len(part)) + 1
            at = np.fromiter((o[0] for o in found.offsets), np.int64, len(found.ids))
            self.ids.append(np.array(found.ids, self.dtype))
            self.ends.append(np.searchsorted(at, np.cumsum(size)) + self.ends[-1][-1])
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
        self.ids, self.ends = [np.concatenate(self.ids)], [np.concatenate(self.ends)]
        return np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each)."""
        # Full stops and commas after a letter are set apart, as the tokenizer does later anyway; fewer
        # distinct pieces are left to encode. Case stays: special tokens are matched before it goes, and
        # marks are composed before it goes.
        data, offsets = text_bytes(texts)
        plain = pa.LargeStringArray.from_buffers(
            len(texts), pa.py_buffer(offsets.copy()), pa.py_buffer(data))
        plain = pc.replace_substring_regex(plain, FULL_STOP, r"\1 \2\3")
        split = pc.split_pattern(pc.replace_substring(plain, "\n", " "), " ")
        words = split.flatten().dictionary_encode()
        n_words = np.diff(split.offsets.to_numpy())
        number = self._numbers(words.dictionary.to_pylist())
        ids, ends = self.ids[0], self.ends[0]
        used = number[words.indices.to_numpy()] if len(words) else number
        first, size = ends[:-1], np.diff(ends)
        length = size[used]
        total = np.concatenate([[0], np.cumsum(length)])
        at = np.repeat(first[used] - total[:-1], length) + np.arange(total[-1])
        cuts = np.concatenate([[0], np.cumsum(n_words)])
        return ids[at], total[cuts[1:]] - total[cuts[:-1]]


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


# ----------------------------------------------------------------------- write
class SequenceWriter:
    """Writes a stream of ids as sequences; holds at most one batch of them."""

    def __init__(self, sink: pa.NativeFile, dtype: type, length: int):
        self.dtype, self.length = dtype, length
        self.schema = pa.schema([
            ("ids", pa.list_(pa.from_numpy_dtype(dtype), length)),
            ("mask", pa.list_(pa.bool_(), length))])
        self.file = pa.ipc.new_file(sink, self.schema)
        self.held: list[np.ndarray] = []
        self.n_held = 0

    def add(self, ids: np.ndarray) -> None:
        self.held.append(ids)
        self.n_held += len(ids)
        while self.n_held >= ROWS * self.length:
            self._write(ROWS)

    def _write(self, rows: int) -> None:
        ids = np.concatenate(self.held) if self.held else np.zeros(0, self.dtype)
        size = rows * self.length
        out, mask = np.zeros(size, self.dtype), np.zeros(size, bool)
        out[:len(ids)], mask[:len(ids)] = ids[:size], True
        self.held, self.n_held = [ids[size:]], max(0, len(ids) - size)
        columns = [pa.FixedSizeListArray.from_arrays(pa.array(v), self.length)
                   for v in (out, mask)]
        self.file.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))

    def close(self) -> None:
        if self.n_held:
            self._write(-(-self.n_held // self.length))
        self.file.close()


def write(docs: DataFrame, folder: str, tokenizer: str, length: int = SEQUENCE,
          end_id: int = END_ID) -> DataFrame:
    """Write ``docs`` (doc_id, text) and return (file, n_tokens), one row per file, in order."""
    dtype = Encoder(tokenizer).dtype
    documents = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, base = fs.FileSystem.from_uri(folder)
        place.create_dir(base, recursive=True)
        number = TaskContext.get().partitionId()
        attempt = f"{base}/.{number}-{uuid.uuid4().hex}"
        codes = encoder(tokenizer)
        tokens = 0
        with place.open_output_stream(f"{attempt}.ids") as one, \
                place.open_output_stream(f"{attempt}.docs") as two:
            ids_file = SequenceWriter(one, dtype, length)
            docs_file = pa.ipc.new_file(two, documents)
            for batch in batches:
                for part in portions(batch, by_text, PORTION):
                    ids, counts = codes.encode(part["text"])
                    ids = np.insert(ids, np.cumsum(counts), end_id)
                    ids_file.add(ids)
                    tokens += len(ids)
                    docs_file.write_batch(pa.RecordBatch.from_arrays(
                        [part["doc_id"], pa.array(counts + 1)], schema=documents))
            ids_file.close()
            docs_file.close()
        name = f"part-{number:06d}"
        for kind in ("ids", "docs"):
            place.move(f"{attempt}.{kind}", f"{base}/{name}.{kind}.arrow")
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([tokens])],
                                         ["file", "n_tokens"])

    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    order = ["doc_id", F.xxhash64("text")]
    ordered = ordered.repartitionByRange(*order).sortWithinPartitions(*order)
    return pin(ordered.mapInArrow(run, "file string, n_tokens long"))


# ------------------------------------------------------------------------ read
class SequenceFile:
    """Random access to a written file: ``ids(i)`` and ``mask(i)`` are views, nothing is copied."""

    def __init__(self, folder: str, name: str):
        place, base = fs.FileSystem.from_uri(folder)
        path = f"{base}/{name}.ids.arrow"
        local = isinstance(place, fs.LocalFileSystem)
        self.reader = pa.ipc.open_file(pa.memory_map(path) if local else place.open_input_file(path))
        self.docs = pa.ipc.open_file(place.open_input_file(f"{base}/{name}.docs.arrow"))
        self.length = self.reader.schema.field("ids").type.list_size

    def batch(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, mask) of the k-th batch, flat."""
        found = self.reader.get_batch(k)
        return (found["ids"].flatten().to_numpy(),
                found["mask"].flatten().to_numpy(zero_copy_only=False))

    def ids(self, i: int) -> np.ndarray:
        part = self.reader.get_batch(i // ROWS)["ids"].slice(i % ROWS, 1)
        return part.flatten().to_numpy()

    def mask(self, i: int) -> pa.Array:
        return self.reader.get_batch(i // ROWS)["mask"].slice(i % ROWS, 1).flatten()

    def documents(self) -> Iterator[tuple[int | None, np.ndarray]]:
        """(doc_id, ids) of each document in order, a batch of sequences at a time."""
        held, k = np.zeros(0, np.uint16), 0
        for b in range(self.docs.num_record_batches):
            batch = self.docs.get_batch(b)
            for doc_id, n in zip(batch["doc_id"].to_pylist(), batch["n_tokens"].to_pylist(),
                                 strict=True):
                if len(held) < n:
                    parts, size = [held], len(held)
                    while size < n:
                        ids, mask = self.batch(k)
                        parts.append(ids[mask])
                        size, k = size + len(parts[-1]), k + 1
                    held = np.concatenate(parts)
                yield doc_id, held[:n]
                held = held[n:]


def read(files: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the written files."""
    # One row per file: a window over them is small.
    before = F.coalesce(F.sum("n_tokens").over(Window.orderBy("file").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    placed = files.withColumn("start", before).select("file", "start")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, start in zip(batch["file"].to_pylist(), batch["start"].to_pylist(),
                                   strict=True):
                rows = []
                for doc_id, ids in SequenceFile(folder, name).documents():
                    crc = zlib.crc32(ids.astype("<u4").tobytes())
                    rows.append((doc_id, start, len(ids), crc))
                    start += len(ids)
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(v, pa.int64()) for v in zip(*rows, strict=True)],
                        ["doc_id", "start", "n_tokens", "ids_crc32"])

    n_files = max(1, files.count())
    return placed.repartition(n_files, "file").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long")


# --------------------------------------------------------------------- queries
def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark)
    folder = f"{folder if ':/' in folder else 'file://' + folder}/tokens-{uuid.uuid4().hex}"
    files = write(table(spark, sf_dir, "documents"), folder,
                  public_tokenizers.path("word_bpe_49k.json"))
    return read(files, folder)
