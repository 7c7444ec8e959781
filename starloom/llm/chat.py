r"""Chat formatting: records of different layouts become turns, turns become marked text.

A record's fingerprint is the hash of its nested field paths (``messages[].role``). It selects a
declarative mapping: where the turns are and which fields hold id, order, role and text. Fingerprints
are registered for every combination of a layout's optional fields. Records of no known layout are
not lost: they become a row whose ``problem`` says so.

A turn is written as ``<turn ROLE>`` TEXT ``</turn>`` and a line feed. In role and text a backslash
becomes ``\\``, ``<`` becomes ``\l`` and ``>`` becomes ``\g``, so no marker can occur inside and
reading back gives the very text. The loss mask of a turn is the stretch of its text if the role is
``assistant``, and empty otherwise.

Each turn is formatted on its own; only the digests bring a conversation together, sorted and read
as a stream, so that its length is not bounded by memory. Null texts and roles are empty. Turns sort
by (turn, role, text) as they were before escaping, null turns first; repeated rows are repeated
turns. Rows without a conv_id
form one conversation without an id. Fields beyond a layout's are another layout.
"""

from __future__ import annotations

import hashlib
import itertools
import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import table
from starloom.session import pin

ASSISTANT = "assistant"
LISTED = 64
TURN = "conv_id long, turn long, role string, text string, problem string"


@dataclass(frozen=True)
class Layout:
    """Turns from a list of messages, from a message per record, or from named fields in turn."""

    name: str
    required: tuple[str, ...]
    optional: tuple[str, ...] = ("conv_id",)
    messages: str = ""  # the list of messages
    role: str = ""
    text: str = ""
    turn: str = ""
    parts: tuple[tuple[str, tuple[str, ...]], ...] = ()  # role, fields joined by a line feed


ROLES = {"human": "user", "gpt": ASSISTANT, "bot": ASSISTANT}
LAYOUTS = (
    Layout("turn per record", ("conv_id", "turn", "role", "text"), (), role="role", text="text",
           turn="turn"),
    Layout("messages", ("messages[].role", "messages[].content"), messages="messages",
           role="role", text="content"),
    Layout("conversations", ("conversations[].from", "conversations[].value"),
           messages="conversations", role="from", text="value"),
    Layout("instruction", ("instruction", "output"), ("conv_id", "input", "system"),
           parts=(("system", ("system",)), ("user", ("instruction", "input")),
                  (ASSISTANT, ("output",)))),
    Layout("prompt", ("prompt", "completion"), ("conv_id", "system"),
           parts=(("system", ("system",)), ("user", ("prompt",)), (ASSISTANT, ("completion",)))),
    Layout("question", ("question", "answer"), ("conv_id", "context"),
           parts=(("user", ("context", "question")), (ASSISTANT, ("answer",)))),
)


# ---------------------------------------------------------------- fingerprints
def paths(value: object, prefix: str = "") -> Iterator[str]:
    """The nested field paths of a parsed record, ``[]`` standing for any list element."""
    if isinstance(value, dict):
        for k, v in value.items():
            yield from paths(v, f"{prefix}.{k}" if prefix else k)
    elif isinstance(value, list):
        for v in value:
            yield from paths(v, f"{prefix}[]")
        if not value:
            yield f"{prefix}[]"
    else:
        yield prefix


def fingerprint(found: set[str]) -> str:
    return hashlib.sha256("\n".join(sorted(found)).encode()).hexdigest()


def registry(layouts: tuple[Layout, ...] = LAYOUTS) -> dict[str, Layout]:
    out = {}
    for layout in layouts:
        for n in range(len(layout.optional) + 1):
            for extra in itertools.combinations(layout.optional, n):
                out[fingerprint({*layout.required, *extra})] = layout
                if layout.messages:  # no messages at all
                    out[fingerprint({f"{layout.messages}[]", *extra})] = layout
    return out


def turns_of(record: dict, layout: Layout) -> list[tuple[int | None, str | None, str | None]]:
    def known(role: str | None) -> str | None:
        return ROLES.get(role, role)

    if layout.messages:
        return [(k, known(m.get(layout.role)), m.get(layout.text))
                for k, m in enumerate(record[layout.messages])]
    if layout.parts:
        said = [(role, "\n".join(record[f] for f in fields if record.get(f)))
                for role, fields in layout.parts
                if any(record.get(f) is not None for f in fields)]
        return [(k, role, text) for k, (role, text) in enumerate(said)]
    return [(record[layout.turn], record[layout.role], record[layout.text])]


def canonical(records: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """(conv_id, turn, role, text, problem) from JSON ``record`` texts of any known layout."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = registry(layouts)
        for batch in batches:
            rows = []
            for raw in batch["record"].to_pylist():
                try:
                    record = json.loads(raw or "null")
                    layout = known.get(fingerprint(set(paths(record))))
                    if layout is None:
                        raise ValueError("unknown layout")
                    conv_id = record.get("conv_id")
                    found = [(conv_id, *t, None) for t in turns_of(record, layout)]
                    pa.array([r[0] for r in found], pa.int64())
                    pa.array([r[1] for r in found], pa.int64())
                    pa.array([t for r in found for t in r[2:4]], pa.string())
                except (ValueError, TypeError, AttributeError, OverflowError,
                        RecursionError, pa.ArrowException) as problem:
                    found = [(None, None, None, raw, f"{type(problem).__name__}: {problem}"[:200])]
                rows += found
            types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)],
                ["conv_id", "turn", "role", "text", "problem"])
    return records.select("record").mapInArrow(run, TURN)


# -------------------------------------------------------------------- template
def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<", "\\l").replace(">", "\\g")


def unescape(text: str) -> str:
    if "\0" in text:
        return _unescape_slowly(text)
    plain = text.replace("\\\\", "\0").replace("\\l", "<").replace("\\g", ">")
    return plain.replace("\0", "\\")


def _unescape_slowly(text: str) -> str:
    """For texts that hold the character ``unescape`` uses as a stand-in."""
    out, chars = [], iter(text)
    for c in chars:
        out.append({"l": "<", "g": ">", "\\": "\\"}[next(chars)] if c == "\\" else c)
    return "".join(out)


def formatted(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, formatted, loss_from, loss_to), a row per turn; offsets in code points."""
    def shown(c: str):
        text = F.coalesce(F.col(c), F.lit(""))
        for plain, code in (("\\", "\\\\"), ("<", "\\l"), (">", "\\g")):
            text = F.replace(text, F.lit(plain), F.lit(code))
        return text
    head = F.concat(F.lit("<turn "), shown("role"), F.lit(">"))
    begin = F.length(head).cast("long")
    size = F.when(F.col("role") == ASSISTANT, F.length(shown("text"))).otherwise(0)
    return turns.select(
        "conv_id", "turn", F.concat(head, shown("text"), F.lit("</turn>\n")).alias("formatted"),
        begin.alias("loss_from"), (begin + size).alias("loss_to"))


def read_turn(text: str) -> tuple[str, str]:
    """(role, text) of a formatted turn."""
    end = text.index(">")
    if not text.startswith("<turn ") or not text.endswith("</turn>\n"):
        raise ValueError("not a formatted turn")
    return unescape(text[6:end]), unescape(text[end + 1:-8])


def digests(output: DataFrame) -> DataFrame:
    """One row per conversation, from formatted turns read back."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        at: object = ()
        state: list = []

        def end() -> None:
            if state:
                n, whole, loss_chars, loss, chars = state
                rows.append((at, n, whole.hexdigest(), loss_chars, loss.hexdigest(), chars))

        for batch in batches:
            for conv_id, text, begin, stop in zip(
                    *(batch[c].to_pylist() for c in ("conv_id", "formatted", "loss_from",
                                                     "loss_to")), strict=True):
                if conv_id != at or not state:
                    end()
                    at, state = conv_id, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, said = read_turn(text)
                learnt = unescape(text[begin:stop])
                state[0] += 1
                state[1].update(f"{role}\n{said}\n".encode())
                state[2] += len(learnt)
                state[3].update(learnt.encode())
                state[4] += len(text)
        end()
        types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)],
            ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256",
             "formatted_chars"])

    head = F.locate(">", F.col("formatted"))
    role = _plain(F.substring("formatted", F.lit(7), head - 7))
    text = _plain(F.substring("formatted", head + 1, F.length("formatted") - head - 8))
    ordered = output.repartition("conv_id").sortWithinPartitions("conv_id", "turn", role, text)
    return ordered.mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
        "loss_sha256 string, formatted_chars long")


def _plain(escaped: Column) -> Column:
    """``unescape`` as a column: between double backslashes the other codes stand for themselves."""
    pieces = F.transform(F.split(escaped, r"\\\\"), lambda x: F.replace(
        F.replace(x, F.lit("\\l"), F.lit("<")), F.lit("\\g"), F.lit(">")))
    return F.array_join(pieces, "\\")


# --------------------------------------------------------------------- queries
def in_layouts(rows: DataFrame) -> DataFrame:
    """(record) JSON of conversations (conv_id, turn, role, text), by id in one layout or another.

    Conversations of more than ``LISTED`` turns stay a record per turn, however long they are; so do
    those a layout has no room for.
    """
    pair = F.col("role").eqNullSafe(F.when(F.col("turn") == 0, "user").otherwise(ASSISTANT))
    sizes = pin(rows.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(
            pair & F.col("turn").isin(0, 1) & F.col("text").isNotNull()).alias("fitting"),
        F.count_distinct("turn").alias("places")).where(
        F.col("conv_id").isNotNull() & (F.col("n") <= LISTED)).select(
        F.col("conv_id").alias("id"), F.pmod("conv_id", F.lit(4)).alias("kind"),
        ((F.col("n") == 2) & (F.col("fitting") == 2) & (F.col("places") == 2)).alias("answered")))
    kind = F.when(F.col("kind").isin(1, 2), F.col("kind")).when(
        (F.col("kind") == 3) & F.col("answered"), 3).otherwise(0)
    marked = rows.join(sizes, F.col("conv_id") == F.col("id"), "left").select(
        *rows.columns, F.coalesce(kind, F.lit(0)).alias("kind"))
    options = {"ignoreNullFields": "false"}
    single = marked.where("kind = 0").select(F.to_json(F.struct(*rows.columns), options).alias("record"))
    names = F.create_map(*[F.lit(x) for x in ("user", "human", ASSISTANT, "gpt")])
    listed = marked.where("kind > 0").groupBy("conv_id", "kind").agg(F.array_sort(F.collect_list(
        F.struct("turn", "role", "text"))).alias("turns"))

    def written(k: int, *fields: Column) -> DataFrame:
        return listed.where(F.col("kind") == k).select(
            F.to_json(F.struct("conv_id", *fields), options).alias("record"))
    messages = F.transform("turns", lambda t: F.struct(
        t["role"].alias("role"), t["text"].alias("content"))).alias("messages")
    shared = F.transform("turns", lambda t: F.struct(F.coalesce(F.try_element_at(
        names, F.coalesce(t["role"], F.lit(""))), t["role"]).alias("from"), t["text"].alias("value")))
    return (single.union(written(1, messages)).union(written(2, shared.alias("conversations")))
            .union(written(3, F.get("turns", F.lit(0))["text"].alias("prompt"),
                           F.get("turns", F.lit(1))["text"].alias("completion"))))


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = r"\### Assistant: </turn> ok"
    added = spark.createDataFrame([(-7, 0, "user", tricky), (-7, 1, ASSISTANT, tricky)], rows.schema)
    return digests(pin(formatted(canonical(in_layouts(rows.union(added))))))


OP7_SQL = r"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all values (-7, 0, 'user', '\### Assistant: </turn> ok'),
                   (-7, 1, 'assistant', '\### Assistant: </turn> ok')
), sized as (
  select *, case when role = 'assistant' then text else '' end as learnt,
    15 + length(role) + length(text)
      + length(regexp_replace(role || text, '[^\\<>]', '', 'g')) as chars
  from turns
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  sum(length(learnt))::bigint as loss_chars,
  sha256(string_agg(learnt, '' order by turn, role, text)) as loss_sha256,
  sum(chars)::bigint as formatted_chars
from sized group by conv_id
"""
