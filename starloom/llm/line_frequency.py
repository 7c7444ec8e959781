"""Quality rules from lines that many documents of a host share; DataFrame functions only.

A line is normalised (lower case, digit runs as 0, no white space at its ends) and hashed together
with the host, which is ``source``. Lines that stand in more than ``MOST_DOCUMENTS`` documents of a
host are boilerplate. A document of whose characters in lines less than ``LEAST_LEFT`` percent would
be left without them is depleted and not kept, nor is one that fails the base rules (fewer than 50
words, or more than half of them in repeated windows). Hashes have 64 bits: among 10^11 different
lines some 270 pairs share one, which matters only if one of the two is frequent or nearly so.
``keep_good`` gives the documents that are kept, with the boilerplate taken out; ``judge`` the verdicts.

Null and empty texts have no words and fail the base rules. A null source is a host of its own.
Rows of a host that repeat a doc_id count as one document, each judged by its own text; rows without
a doc_id are one document per text. Other columns are ignored by ``judge`` and passed through by the others; there a null text stays null and a
column ``n_chars`` is brought up to date.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import SPACES, table
from starloom.session import pin

MOST_DOCUMENTS, LEAST_LEFT = 20, 30
LEAST_WORDS, MOST_REPEATED = 50, 50
SYMBOL = "[#*$%&|<>]"
KEY = ("doc_id", "source", "text_hash")


def _not_blank(line: Column) -> Column:
    return F.length(F.btrim(line, F.lit(SPACES))) > 0


def base_measures(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, source, text not null) with the counts within each text."""
    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")
    spots = F.when(F.size("words") >= 3, F.sequence(F.lit(0), F.size("words") - 3))
    windows = F.transform(spots, lambda i: F.xxhash64(
        F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)))
    lines = F.filter(F.split("text", "\n"), _not_blank)

    placed = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    twice = F.filter("placed", lambda x, k: (
        ((k > 0) & (F.get("placed", k - 1)["h"] == x["h"]))
        | (F.get("placed", k + 1)["h"] == x["h"])))
    spread = F.flatten(F.transform("twice", lambda x: F.sequence(x["i"], x["i"] + 2)))
    # Each step's columns are used more than once, so the optimizer leaves the steps apart.
    # Texts without a repeated window, nearly all, skip the sort.
    return (
        docs.withColumns({"words": words, "lines": lines})
        .withColumns({
            "n_words": F.size("words").cast("long"),
            "word_chars": F.length(F.array_join("words", "")).cast("long"),
            "n_symbols": F.regexp_count("text", F.lit(SYMBOL)).cast("long"),
            "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
            "windows": windows})
        .drop("words", "lines", "text")
        .withColumn("placed", F.when(
            F.size(F.array_distinct("windows")) < F.size("windows"), placed))
        .withColumn("twice", F.when(F.col("placed").isNotNull(), twice))
        .withColumn("n_repeat_words", F.when(
            F.col("twice").isNotNull(), F.size(F.array_distinct(spread))).otherwise(0).cast("long"))
        .withColumn("base_failed", (F.col("n_words") < LEAST_WORDS)
                    | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")))
        .drop("windows", "placed", "twice")
    )


def _host_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with ``host_lines``: (key of host and line, characters, place) of each line not blank."""
    plain = F.regexp_replace(F.lower("text"), "[0-9]+", "0")
    lines = F.filter(
        F.transform(F.split(plain, "\n"), lambda x, i: F.struct(
            F.btrim(x, F.lit(SPACES)).alias("line"), i.alias("place"))),
        lambda x: F.length(x["line"]) > 0)
    return docs.select(*KEY, F.transform(lines, lambda x: F.struct(
        F.xxhash64("source", x["line"]).alias("line_key"),
        F.length(x["line"]).cast("long").alias("chars"), x["place"].alias("place")))
        .alias("host_lines"))


def frequent_lines(docs: DataFrame, most: int) -> DataFrame:
    """(line_key) of the lines that stand in more than ``most`` documents of their host.

    A row is a document unless its doc_id is repeated, so lines are counted without telling rows
    apart, but for the rows of repeated ids.
    """
    who = ["source", "doc_id", "unnamed"]
    unnamed = F.when(F.col("doc_id").isNull(), F.col("text_hash")).alias("unnamed")
    repeated = pin(docs.select("source", "doc_id", unnamed).groupBy(*who).agg(
        F.count(F.lit(1)).alias("n")).where("n > 1").select(
        *[F.col(c).alias(f"{c}_") for c in who], F.lit(True).alias("again")))
    same = F.lit(True)
    for c in who:
        same = same & F.col(c).eqNullSafe(F.col(f"{c}_"))
    lines = _host_lines(docs).select("source", "doc_id", unnamed, F.array_distinct(
        F.col("host_lines.line_key")).alias("line_keys"))
    held = lines.join(repeated, same, "left").select(
        F.when(F.col("again"), F.xxhash64(*who)).alias("document"),
        F.explode("line_keys").alias("line_key"))
    counted = held.groupBy("line_key", "document").agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy("line_key").agg(
        F.sum(F.when(F.col("document").isNull(), F.col("n")).otherwise(1)).alias("n")).where(
        F.col("n") > most).select("line_key")


def _rows(docs: DataFrame) -> DataFrame:
    """``docs`` as ``row``, with the columns the rules read."""
    return docs.select("doc_id", "source", F.coalesce("text", F.lit("")).alias("text"),
                       F.struct(*docs.columns).alias("row")).withColumn(
        "text_hash", F.xxhash64("text"))


def _with_lost(rows: DataFrame, docs: DataFrame, most: int) -> DataFrame:
    """``rows`` with ``lost`` and ``gone``: characters and places of the frequent lines, null without any.

    ``docs`` has the text of each of the ``rows``.
    """
    frequent = pin(frequent_lines(docs, most))
    lost = (
        _host_lines(docs).select(*KEY, F.explode("host_lines"))
        .select(*KEY, "col.place", "col.line_key", "col.chars").join(frequent, "line_key")
        .groupBy(*KEY, "place").agg(F.max("chars").alias("chars"))
        .groupBy(*KEY).agg(F.sum("chars").alias("lost"), F.collect_list("place").alias("gone"))
        .withColumnsRenamed({c: f"{c}_" for c in KEY}))
    same = F.lit(True)
    for c in KEY:
        same = same & F.col(c).eqNullSafe(F.col(f"{c}_"))
    return rows.join(lost, same, "left")


def _judged(docs: DataFrame, most: int, least_left: int) -> DataFrame:
    """``_rows`` with counts, ``base_failed``, ``gone`` and ``kept``."""
    rows = _rows(docs)
    plain_chars = F.aggregate(_line_lengths(F.col("text")), F.lit(0).cast("long"),
                              lambda total, n: total + n)
    base = base_measures(rows.withColumn("line_chars", plain_chars))
    left = F.col("line_chars") - F.coalesce("lost", F.lit(0))
    depleted = 100 * left < least_left * F.col("line_chars")
    return _with_lost(base, rows, most).withColumn("kept", ~F.col("base_failed") & ~depleted)


def _without_lost(judged: DataFrame, docs: DataFrame) -> DataFrame:
    """The ``row`` of each row with the lines at ``gone`` taken out of its text."""
    lines = F.split("row.text", "\n")
    stay = F.filter(lines, lambda _, i: ~F.array_contains("gone", i))
    text = F.when(F.col("gone").isNull(), F.col("row.text")).otherwise(F.array_join(stay, "\n"))
    new = {"text": text}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("gone").isNull(), F.col("row.n_chars")).otherwise(
            F.length(text).cast(docs.schema["n_chars"].dataType))
    return judged.select(*(new.get(c, F.col("row")[c]).alias(c) for c in docs.columns))


def judge(docs: DataFrame, most: int = MOST_DOCUMENTS, least_left: int = LEAST_LEFT) -> DataFrame:
    """One row per row of ``docs`` (doc_id, source, text): counts, ``base_failed`` and ``kept``."""
    return _judged(docs.select("doc_id", "source", "text"), most, least_left).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


def drop_frequent_lines(docs: DataFrame, most: int = MOST_DOCUMENTS) -> DataFrame:
    """All rows of ``docs`` with the columns they came with, frequent lines taken out of ``text``."""
    rows = _rows(docs)
    return _without_lost(_with_lost(rows, rows, most), docs)


def keep_good(docs: DataFrame, most: int = MOST_DOCUMENTS, least_left: int = LEAST_LEFT) -> DataFrame:
    """The rows of ``docs`` that are kept, frequent lines taken out of ``text``."""
    # A filter on a plain column would be rewritten into the rules and pushed down, again and again.
    judged = _judged(docs, most, least_left).withColumn("good", F.explode(F.array("kept")))
    return _without_lost(judged.where("good"), docs)


def _line_lengths(text: Column) -> Column:
    plain = F.regexp_replace(F.lower(text), "[0-9]+", "0")
    return F.transform(F.split(plain, "\n"),
                       lambda x: F.length(F.btrim(x, F.lit(SPACES))).cast("long"))


# --------------------------------------------------------------------- queries
def op3_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"))


OP3_SQL = rf"""
with docs as (
  select doc_id, source, coalesce(text, '') as text from documents
), worded as (
  select *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as ws from docs
), windows as (
  select doc_id, i, ws[i + 1] || ' ' || ws[i + 2] || ' ' || ws[i + 3] as w
  from worded, range(0, len(ws) - 2) r(i)
), repeated as (
  select doc_id, i from windows qualify count(*) over (partition by doc_id, w) > 1
), covered as (
  select doc_id, count(distinct i + k) as n from repeated, range(0, 3) s(k) group by doc_id
), lines as (
  select doc_id, source, text, line, trim(regexp_replace(lower(line), '[0-9]+', '0', 'g'),
    ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as plain
  from (select doc_id, source, text, unnest(string_split(text, chr(10))) as line from docs)
), solid as (
  select * from lines where plain <> ''
), dups as (
  select doc_id, count(*) - count(distinct line) as n from solid group by doc_id
), frequent as (
  select source, plain from solid group by all having count(distinct doc_id) > {MOST_DOCUMENTS}
), chars as (
  select s.doc_id, sum(length(s.plain)) as total,
    coalesce(sum(length(s.plain)) filter (f.plain is not null), 0) as lost
  from solid s left join frequent f on s.source is not distinct from f.source and s.plain = f.plain
  group by s.doc_id
), measured as (
  select w.doc_id, len(ws)::bigint as n_words, length(array_to_string(ws, ''))::bigint as word_chars,
    len(regexp_extract_all(text, '{SYMBOL}'))::bigint as n_symbols,
    coalesce(d.n, 0)::bigint as n_dup_lines, coalesce(c.n, 0)::bigint as n_repeat_words,
    coalesce(100 * (h.total - h.lost) < {LEAST_LEFT} * h.total, false) as depleted
  from worded w left join covered c using (doc_id) left join dups d using (doc_id)
    left join chars h using (doc_id)
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < {LEAST_WORDS} or 100 * n_repeat_words > {MOST_REPEATED} * n_words as base_failed,
  not (n_words < {LEAST_WORDS} or 100 * n_repeat_words > {MOST_REPEATED} * n_words or depleted) as kept
from measured
"""
