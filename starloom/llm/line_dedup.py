"""Line dedup: passages of three consecutive lines that occur again are removed there.

Every run of three lines (split at line feeds, compared as they are) is hashed to 128 bits. The
first occurrence of a run is the one with the smallest (doc_id, hash of the text, line); all later
ones are removed, also later ones in the same text, where overlapping runs merge into one stretch.
Runs of blank lines only are no passage, texts of fewer than three lines have none.

A null text stays null and an empty one empty; a null doc_id sorts first. Repeated rows (same doc_id
and text) are one document: they are treated alike and are no repetition of each other. All columns
are passed through; in ``drop_repeated_lines`` a column ``n_chars`` is brought up to date.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import SPACES, table
from starloom.session import pin

RUN = 3


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _runs(lines: Column) -> Column:
    """(line, hash_a, hash_b) of every run that is not blank; null if the text is too short."""
    def run(i: Column) -> Column:
        parts = [F.get(lines, i + k) for k in range(RUN)]
        return F.struct(
            i.alias("line"), F.xxhash64(*parts).alias("hash_a"),
            F.xxhash64(F.lit(RUN), *reversed(parts)).alias("hash_b"),
            (F.length(F.btrim(F.concat(*parts), F.lit(SPACES))) == 0).alias("blank"))
    return F.when(F.size(lines) >= RUN, F.transform(
        F.sequence(F.lit(0), F.size(lines) - RUN), run))


def repeated_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, covered): the line numbers to remove, for each text that has any."""
    place = ["doc_id", "text_hash", "line"]
    # The lines are a column of their own, or each step of the loop would split the text again.
    split = docs.select("doc_id", F.xxhash64("text").alias("text_hash"),
                        _lines(F.col("text")).alias("lines"))
    runs = (split.select("doc_id", "text_hash", F.inline(_runs(F.col("lines"))))
            .where(~F.col("blank")).drop("blank"))
    # Many rows of a hot passage become one here before they move.
    repeated = pin(runs.groupBy("hash_a", "hash_b").agg(
        F.min(F.struct(*place)).alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1").drop("n"))
    later = runs.join(repeated, ["hash_a", "hash_b"]).where(
        ~F.struct(*place).eqNullSafe(F.col("first")))
    lines = F.flatten(F.transform(F.collect_set("line"), lambda i: F.sequence(i, i + RUN - 1)))
    return later.groupBy("doc_id", "text_hash").agg(
        F.array_sort(F.array_distinct(lines)).alias("covered"))


def with_kept_text(docs: DataFrame) -> DataFrame:
    """(row, lines, covered, kept): every row as a struct, its lines, the numbers of those removed
    (null if none) and the text that stays."""
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"),
                       F.xxhash64("text").alias("hash"), _lines(F.col("text")).alias("lines"))
    covered = repeated_lines(docs.select("doc_id", "text")).withColumnsRenamed(
        {"doc_id": "covered_id", "text_hash": "covered_hash"})
    joined = rows.join(covered, F.col("id").eqNullSafe(F.col("covered_id"))
                       & (F.col("hash") == F.col("covered_hash")), "left")
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("covered"))
    kept = F.array_join(F.transform(stay, lambda i: F.get("lines", i)), "\n")
    return joined.select("row", "lines", "covered", F.when(
        F.col("covered").isNull(), F.col("row.text")).otherwise(kept).alias("kept"))


def drop_repeated_lines(docs: DataFrame, drop_emptied: bool = False) -> DataFrame:
    """``docs`` with the columns it came with, repeated passages removed from ``text``.

    ``drop_emptied`` leaves out documents that lost lines and have nothing but white space left.
    """
    found = with_kept_text(docs)
    if drop_emptied:
        gone = F.col("covered").isNotNull() & (
            F.length(F.btrim("kept", F.lit(SPACES))) == 0)
        found = found.where(~gone)
    new = {"text": F.col("kept")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("kept").cast(docs.schema["n_chars"].dataType)
    return found.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


# --------------------------------------------------------------------- queries
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return with_kept_text(docs).select(
        F.col("row.doc_id").alias("doc_id"), F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("covered"), F.lit(0)).cast("long").alias("n_removed"),
        F.col("kept").alias("text"))


OP4_SQL = """
with lines as (
  select doc_id, text, string_split(coalesce(text, ''), chr(10)) as ls from documents
), runs as (
  select doc_id, i as line, ls[i + 1] || chr(10) || ls[i + 2] || chr(10) || ls[i + 3] as run
  from lines, range(0, len(ls) - 2) r(i)
), numbered as (
  select doc_id, line, row_number() over (partition by run order by doc_id, line) as occurrence
  from runs where regexp_matches(run, '[^\\x20\\x09-\\x0D]')
), covered as (
  select distinct doc_id, line + k as line
  from numbered, range(0, 3) s(k) where occurrence > 1
), split as (
  select doc_id, i as line, ls[i + 1] as content from lines, range(0, len(ls)) r(i)
), kept as (
  select s.doc_id, string_agg(s.content, chr(10) order by s.line) as text, count(*) as n
  from split s anti join covered c on s.doc_id = c.doc_id and s.line = c.line
  group by s.doc_id
)
select l.doc_id, len(l.ls)::bigint as n_lines, (len(l.ls) - coalesce(k.n, 0))::bigint as n_removed,
       case when l.text is null then null else coalesce(k.text, '') end as text
from lines l left join kept k on l.doc_id = k.doc_id
"""
