"""Secret scans: fixed patterns, and strings that look random; DataFrame functions only.

Two character Markov models (pairs of neighbouring characters) are trained from labelled strings:
random ones are values of ``LEAST_RANDOM`` and more characters, letters and digits both, that the
fixed patterns caught; ordinary ones the identifiers and words of 4 to 19 characters of texts in
which they caught nothing, but for those that are scored. An unbroken string is reported when its log-likelihood under the first
exceeds that under the second by ``LEAST_RATIO`` and on average by ``LEAST_MEAN`` per pair. Scored are
all strings of 20 and more characters and, from 8 characters on, those with a letter and a digit or
with a capital after a small letter; shorter runs of letters of one case are words, those without
letters numbers. The models are fitted on at
most ``SAMPLE`` texts of each kind (smallest hash of the id), the tables have a row per pair of
characters; all else runs over all texts.

Offsets count code points, ends are exclusive. Matches are leftmost and do not overlap within a kind;
strings that touch a fixed pattern's match are not reported again. Null and empty texts have no
spans. Rows without a doc_id are scanned but not learnt from; repeated rows are scanned alike.
Without labelled strings a model is uniform. Other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import table
from starloom.session import pin

# The base patterns and the least length of what they must hold.
ASSIGN = (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
          r"([A-Za-z0-9+/_.=-]+)")
ACCESS, HEX = "AKIA[A-Z0-9]+", "[0-9a-f]+"
LEAST = {"assign": 8, "access": 16, "hex": 32}

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
LEAST_MIXED, LEAST_PLAIN, LEAST_RANDOM = 8, 20, 12
# A letter, and a digit or a capital after a small letter.
MIXED = (r"(?=[0-9+/_-]*[A-Za-z])(?:[A-Za-z+/_-]*[0-9]|[A-Z0-9+/_-]*[a-z][a-z0-9+/_-]*[A-Z])")
STRING = (rf"(?<![A-Za-z0-9+/_-])(?:(?={MIXED})[A-Za-z0-9+/_-]{{{LEAST_MIXED},}}"
          rf"|[A-Za-z0-9+/_-]{{{LEAST_PLAIN},}})")
IDENTIFIER = (rf"(?<![A-Za-z0-9+/_-])(?:[A-Za-z0-9+/_-]{{4,7}}|(?!{MIXED})[A-Za-z0-9+/_-]{{8,19}})"
              r"(?![A-Za-z0-9+/_-])")
SAMPLE = 2000
LEAST_RATIO, LEAST_MEAN, BACKED = 8.0, 0.5, 20
KINDS = ("assign", "access", "hex", "markov")


# ----------------------------------------------------------------------- spans
def matches(text: Column, pattern: str, value: int = 0) -> Column:
    """(start, end, value) of every match of ``pattern``; the value is that group of it.

    Splitting at the matches gives the stretches between them; their lengths add up to the places.
    """
    gaps = F.split(text, pattern, -1)
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    inner = F.regexp_extract_all(text, F.lit(pattern), F.lit(value))
    size = F.transform(F.arrays_zip(gaps.alias("gap"), whole.alias("found"), inner.alias("value")),
                       lambda x: F.struct(F.length(x["gap"]).alias("gap"),
                                          F.length(x["found"]).alias("found"),
                                          x["value"].alias("value")))
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    begin = F.struct(F.lit(0).alias("at"), none.alias("spans"))

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + x["gap"]
        end = start + x["found"]
        span = F.struct(start.alias("start"), end.alias("end"), x["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

    found = F.filter(size, lambda x: x["found"].isNotNull())
    return F.aggregate(found, begin, step, lambda state: state["spans"])


def _none() -> Column:
    return F.array().cast("array<struct<start:int,end:int,value:string>>")


def base_spans(text: Column) -> dict[str, Column]:
    """The spans of each fixed pattern that pass its length rule."""
    # For the two patterns of one class the length can be asked for in the pattern: a match is a
    # whole run of the class, and no shorter match could come in between.
    found = {
        "assign": F.when(text.rlike(ASSIGN), F.filter(
            matches(text, ASSIGN, 2), lambda x: F.length(x["value"]) >= LEAST["assign"])),
        "access": F.when(text.contains("AKIA"), matches(
            text, f"AKIA[A-Z0-9]{{{LEAST['access'] - 4},}}")),
        "hex": F.when(text.rlike(f"[0-9a-f]{{{LEAST['hex']}}}"), matches(
            text, f"[0-9a-f]{{{LEAST['hex']},}}")),
    }
    return {kind: F.coalesce(spans, _none()) for kind, spans in found.items()}


def written(spans: dict[str, Column]) -> Column:
    """kind:start:end of all spans by start, then kind, joined by commas."""
    def listed(place: int, kind: str) -> Column:
        return F.transform(spans[kind], lambda x: F.struct(
            x["start"].alias("start"), F.lit(place).alias("kind"),
            F.concat_ws(":", F.lit(kind), x["start"].cast("string"), x["end"].cast("string"))
            .alias("shown")))
    parts = [listed(place, kind) for place, kind in enumerate(spans)]
    return F.array_join(F.transform(F.sort_array(F.concat(*parts)), lambda x: x["shown"]), ",")


# ---------------------------------------------------------------------- models
def labelled_strings(docs: DataFrame) -> DataFrame:
    """(string, random): what the fixed patterns caught, and ordinary identifiers and words."""
    text = F.col("text")
    caught = text.rlike(ASSIGN) | text.contains("AKIA") | text.rlike(
        f"[0-9a-f]{{{LEAST['hex']}}}")
    told = pin(docs.where("doc_id is not null").select(
        F.col("doc_id").alias("id"), caught.cast("int").alias("random")))
    # At most SAMPLE ids of each kind, so they are few enough to send to every task.
    picked = [told.where(F.col("random") == r).distinct().orderBy(F.xxhash64("id"), "id").limit(SAMPLE)
              for r in (0, 1)]
    texts = docs.join(F.broadcast(picked[0].union(picked[1])), F.col("doc_id") == F.col("id"))
    spans = base_spans(text)
    values = F.concat(*[F.transform(s, lambda x: x["value"]) for s in spans.values()])
    drawn = F.filter(values, lambda v: (F.length(v) >= LEAST_RANDOM) & v.rlike("[0-9]")
                     & v.rlike("[A-Za-z]"))
    usual = F.regexp_extract_all(text, F.lit(IDENTIFIER), F.lit(0))
    return texts.select(F.explode(F.when(F.col("random") == 1, drawn).otherwise(usual))
                        .alias("string"), "random")


def train(docs: DataFrame) -> list[float]:
    """Log ratio of the two models for each pair of characters of the alphabet."""
    pairs = labelled_strings(docs).where(F.length("string") >= 2).select("random", F.explode(
        F.transform(F.sequence(F.lit(1), F.length("string") - 1),
                    lambda i: F.substring("string", i, F.lit(2)))).alias("pair"))
    counts = pairs.where(F.col("pair").rlike("^[A-Za-z0-9+/_-]{2}$")).groupBy("random", "pair").count()
    seen = {(r["random"], r["pair"]): r["count"] for r in counts.collect()}  # at most 2 * 66 * 66
    ratio, size = [], len(ALPHABET)
    into = [[sum(seen.get((c, a + b), 0) for a in ALPHABET) for b in ALPHABET] for c in (0, 1)]
    share = [[(n + 0.5) / (sum(into[c]) + 0.5 * size) for n in into[c]] for c in (0, 1)]
    for a in ALPHABET:
        total = [sum(seen.get((c, a + b), 0) for b in ALPHABET) for c in (0, 1)]
        for k, b in enumerate(ALPHABET):
            # After characters seldom seen, how common the next one is on the whole decides.
            p = [(seen.get((c, a + b), 0) + BACKED * share[c][k]) / (total[c] + BACKED)
                 for c in (0, 1)]
            ratio.append(math.log(p[1] / p[0]))
    return ratio


def random_spans(text: Column, ratio: list[float]) -> Column:
    """Strings that are likelier under the model of random strings."""
    table_of = F.split(F.lit(",".join(f"{x:.6f}" for x in ratio)), ",").cast("array<double>")

    def letter(s: Column, i: Column) -> Column:
        return F.instr(F.lit(ALPHABET), F.substring(s, i, F.lit(1))) - 1

    def likely(x: Column) -> Column:
        s = x["value"]
        total = F.aggregate(
            F.sequence(F.lit(1), F.length(s) - 1), F.lit(0.0),
            lambda acc, i: acc + F.get(table_of, letter(s, i) * len(ALPHABET) + letter(s, i + 1)))
        return (total >= LEAST_RATIO) & (total >= LEAST_MEAN * (F.length(s) - 1))

    return F.coalesce(F.when(text.rlike(STRING), F.filter(
        matches(text, STRING), likely)), _none())


def scan(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with a column of spans (start, end, value) per kind."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    ratio = train(rows)
    found = rows.withColumns({**base_spans(F.col("text")),
                              "markov": random_spans(F.col("text"), ratio)})
    base = F.concat(*[F.col(k) for k in KINDS[:3]])
    return found.withColumn("markov", F.filter("markov", lambda x: ~F.exists(
        base, lambda y: (y["start"] < x["end"]) & (x["start"] < y["end"]))))


# --------------------------------------------------------------------- queries
def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    kinds = {k: F.col(k) for k in KINDS}
    base = {k: kinds[k] for k in KINDS[:3]}
    return found.select(
        "doc_id", *[F.size(s).cast("long").alias(f"n_{k}") for k, s in base.items()],
        F.sha2(written(base), 256).alias("base_sha256"), written(kinds).alias("spans"))
