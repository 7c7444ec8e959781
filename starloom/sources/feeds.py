"""Text feeds: CSV in, all-text staging tables out.

A file is read once, line by line, whatever it is split into. A record may run over several lines: a
line break inside quotes leaves the line with an odd number of quotes. Whether a line starts inside
quotes follows from the number of odd lines before it in the file, so the odd lines are numbered,
per block and then over the blocks of the file in their order. An odd line opens a record, the next
one closes it, also in another block. Only lines of such records move, to be sewn together.

A line is kept for quarantine if it has too few or too many fields, if a quote stands inside an
unquoted field, or if it opens a record that never closes or closes after more than ``MOST_LINES``
lines; then the lines in between stand for themselves.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader

from starloom.schemas import Feed
from starloom.session import shared_folder
from starloom.sources.tables import write_table

MALFORMED = "malformed_line"
PLACE = "line_place"
#: The text of a well-formed line with quotes; other lines can be put together from their fields.
QUOTED = "quoted_line"
MOST_LINES = 10_000


# ----------------------------------------------------------------------- parsing
def _replaced(text: Column, old: str, new: str) -> Column:
    return F.replace(text, F.lit(old), F.lit(new))


def _is_odd(text: Column) -> Column:
    return (F.length(text) - F.length(_replaced(text, '"', ""))) % 2 == 1


def _fields(text: Column) -> Column:
    """Raw fields: commas between quotes do not separate."""
    pieces = F.transform(F.split(text, '"'), lambda piece, i: F.when(
        i % 2 == 0, _replaced(piece, ",", "\0")).otherwise(piece))
    return F.when(text.contains('"'), F.split(F.array_join(pieces, '"'), "\0")).otherwise(
        F.split(text, ","))


def _inner(field: Column) -> Column:
    return F.substring(field, F.lit(2), F.length(field) - 2)


def _badly_quoted(field: Column) -> Column:
    whole = (field.startswith('"') & field.endswith('"') & (F.length(field) > 1)
             & ~_replaced(_inner(field), '""', "").contains('"'))
    return field.contains('"') & ~whole


def parse(lines: DataFrame, feed: Feed) -> DataFrame:
    """The fields of ``value`` as text columns by position, other columns as they are.

    An unquoted empty field is null, a quoted one an empty text.
    """
    value, raw = F.col("value"), F.col("_fields")
    split = lines.withColumn("_fields", _fields(value))
    bad_quotes = value.contains('"') & (
        _is_odd(value) | value.contains("\0") | F.exists(raw, _badly_quoted))
    judged = split.withColumn("_bad", bad_quotes)

    def field(i: int) -> Column:
        text = F.get(raw, F.lit(i))
        return F.when(~F.col("_bad") & (text != ""), F.when(
            text.startswith('"'), _replaced(_inner(text), '""', '"')).otherwise(text))
    malformed = F.col("_bad") | (F.size(raw) != len(feed.columns))
    return judged.select(
        *[field(i).alias(c) for i, c in enumerate(feed.columns)],
        F.when(malformed, value).alias(MALFORMED),
        F.when(~malformed & value.contains('"'), value).alias(QUOTED),
        *[c for c in lines.columns if c != "value"])


def _raw(feed: Feed) -> Column:
    """The text of a parsed line."""
    again = F.array_join(F.array(*[F.coalesce(c, F.lit("")) for c in feed.columns]), ",")
    return F.coalesce(MALFORMED, QUOTED, again)


# --------------------------------------------------------------- records over lines
def _blocks(lines: DataFrame) -> DataFrame:
    """One row per block of a file: its lines, and the odd ones before it in the file.

    The first line of a file is its header and counts as no line.
    """
    odd = F.coalesce(_is_odd(F.col(MALFORMED)), F.lit(False)).cast("int")
    file, block, row = (F.col(f"{PLACE}.{c}") for c in ("file", "block", "row"))
    found = lines.select(file, block, row, odd.alias("odd")).groupBy("file", "block").agg(
        F.min("row").alias("first"), F.max("row").alias("last"), F.sum("odd").alias("odd"),
        F.min_by("odd", "row").alias("first_odd"))
    head = F.col("block") == 0
    in_file = Window.partitionBy("file").orderBy("block")
    before = in_file.rowsBetween(Window.unboundedPreceding, -1)
    return found.withColumn("odd", F.col("odd") - F.when(head, F.col("first_odd")).otherwise(0)) \
        .select(
            "file", "block", "first", "last", "odd", head.alias("head"),
            F.row_number().over(in_file).alias("number"),
            F.coalesce(F.sum("odd").over(before), F.lit(0)).alias("odd_before"),
            F.coalesce(F.sum(F.col("last") - F.col("first") + 1).over(before), F.lit(0))
            .alias("lines_before"))


def _broken(lines: DataFrame, blocks: DataFrame) -> DataFrame:
    """(row, number, start, place) of the lines of records that run over several lines.

    ``start`` is the row of the record's first line, which alone carries its ``place``.
    """
    odd = lines.where(_is_odd(F.col(MALFORMED))).select(f"{PLACE}.*").join(
        blocks, ["file", "block"]).where(~(F.col("head") & (F.col("row") == F.col("first"))))
    nth = F.col("odd_before") + F.row_number().over(
        Window.partitionBy("file", "block").orderBy("row"))
    end = F.struct((F.col("lines_before") + F.col("row") - F.col("first")).alias("line"),
                   "number", "row")
    pairs = odd.select("file", F.floor((nth + 1) / 2).alias("record"), end.alias("end")).groupBy(
        "file", "record").agg(F.count(F.lit(1)).alias("n"), F.min("end").alias("a"),
                              F.max("end").alias("z"))
    whole = pairs.where("n = 2").where(F.col("z.line") - F.col("a.line") < MOST_LINES)
    there = blocks.select("file", "number", "block", "first", "last")
    found = whole.select(
        "file", "record", "a", "z",
        F.explode(F.sequence(F.col("a.number"), F.col("z.number"))).alias("number")).join(
        there, ["file", "number"]).select(
        "file", "block", "number", F.col("a.row").alias("start"), F.explode(F.sequence(
            F.when(F.col("number") == F.col("a.number"), F.col("a.row")).otherwise(F.col("first")),
            F.when(F.col("number") == F.col("z.number"), F.col("z.row")).otherwise(F.col("last")),
        )).alias("row"))
    return found.select("row", "number", "start", F.when(
        F.col("row") == F.col("start"), F.struct("file", "block", "row")).alias("place"))


def _sewn(lines: DataFrame, broken: DataFrame, feed: Feed) -> DataFrame:
    """The records of the ``broken`` lines, each at the place of its first line.

    Lines move as one text and their row, not as fields beside the text and the path of their file.
    """
    texts = lines.select(F.col(f"{PLACE}.row").alias("row"), _raw(feed).alias("text"))
    part = F.struct("number", "row", "text", "place")
    records = texts.join(broken, "row").groupBy("start").agg(
        F.array_sort(F.collect_list(part)).alias("parts"))
    return parse(records.select(
        F.array_join("parts.text", "\n").alias("value"),
        F.get("parts", F.lit(0))["place"].alias(PLACE)), feed).drop(QUOTED)


def _as_bits(rows: DataFrame) -> DataFrame:
    """(word, bits) with a bit set for each ``row``: 64 rows to a word.

    Lines are then left out by a table of two bits or so a line, which Spark can broadcast for feeds
    of gigabytes, so that their text stays where it is.
    """
    bit = F.expr("shiftleft(1L, cast(row & 63 as int))")
    return rows.groupBy(F.shiftright("row", 6).alias("word")).agg(F.bit_or(bit).alias("bits"))


# ------------------------------------------------------------------------- staging
def text_lines(reader: DataFrameReader | DataStreamReader, path: str) -> DataFrame:
    """(value, file, block) of the lines of a file or folder."""
    return reader.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"))


def stage_feed(spark: SparkSession, path: str | None, feed: Feed, folder: str) -> int:
    """Land a file or folder of CSV as staging tables; returns the number of records.

    Without a path the feed is staged without records.
    """
    if path is None:
        nothing = spark.createDataFrame([], "value string, file string, block long")
        return stage_lines(nothing, feed, folder)
    return stage_lines(text_lines(spark.read, path), feed, folder)


def stage_lines(lines: DataFrame, feed: Feed, folder: str) -> int:
    """Land ``lines`` (value, file, block); returns the number of records.

    ``lines`` holds every line parsed by itself, ``taken`` a bit for each line that is no record by
    itself, ``sewn`` the records put together from several lines.
    """
    spark = lines.sparkSession
    place = F.struct("file", "block", F.monotonically_increasing_id().alias("row"))
    write_table(parse(lines.select("value", place.alias(PLACE)), feed), f"{folder}/lines")
    lines = spark.read.parquet(f"{folder}/lines")
    write_table(_blocks(lines), f"{folder}/blocks")
    blocks = spark.read.parquet(f"{folder}/blocks")
    n_lines, n_files, n_odd = blocks.agg(
        F.coalesce(F.sum(F.col("last") - F.col("first") + 1), F.lit(0)), F.count_if("head"),
        F.coalesce(F.sum("odd"), F.lit(0))).first()
    headers = blocks.where("head").select(F.col("first").alias("row"))
    if not n_odd:
        write_table(_as_bits(headers), f"{folder}/taken")
        write_table(lines.limit(0).drop(QUOTED), f"{folder}/sewn")
        return n_lines - n_files
    write_table(_broken(lines, blocks), f"{folder}/broken")
    broken = spark.read.parquet(f"{folder}/broken")
    write_table(_as_bits(headers.union(broken.select("row"))), f"{folder}/taken")
    write_table(_sewn(lines, broken, feed), f"{folder}/sewn")
    return n_lines - n_files - broken.count() + spark.read.parquet(f"{folder}/sewn").count()


def read_staged(spark: SparkSession, folder: str) -> DataFrame:
    """The records of a staged feed: text columns, ``malformed_line`` and ``line_place``, which
    orders them by (file, block, row) as they stand in the files."""
    taken = spark.read.parquet(f"{folder}/taken")
    lines = spark.read.parquet(f"{folder}/lines")
    row = lines[f"{PLACE}.row"]
    single = lines.join(
        taken, (F.shiftright(row, 6) == taken["word"])
        & (F.getbit(taken["bits"], row.bitwiseAND(F.lit(63)).cast("int")) == 1), "left_anti")
    return single.drop(QUOTED).unionByName(spark.read.parquet(f"{folder}/sewn"))


def read_csv(spark: SparkSession, path: str, feed: Feed) -> DataFrame:
    """The records of ``path``, staged in the shared folder."""
    folder = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    stage_feed(spark, path, feed, folder)
    return read_staged(spark, folder)
