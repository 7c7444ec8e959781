"""Filter interaction audit: what every order of the quality filters would remove, step by step.

A document's filters make a mask of failures. Under an order it goes at the first filter it fails.
The orders that agree in their first steps are neighbours in the lexicographic list of all orders
(their Lehmer ranks form an interval), so a mask's removals at a step cover whole intervals of
ranks. Each (part, mask) adds its counts where an interval begins and takes them off where it ends;
a running sum over the ranks then gives every order at once. Documents meet the orders only as
counts per part and mask, at most ``2 ** len(FILTERS)`` of them a part.

Null texts are empty, null parts are the part ''. A null doc_id has no place in the order of
documents: it neither fails the copy filter nor makes others fail it, and it has no labels. Rows
that repeat a doc_id are documents of their own, and none is a copy of the other; labels that repeat
a doc_id count if any of them does. Columns beyond those named are ignored. An empty table has no
parts and no rows.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.llm.common import table, word_count
from starloom.session import pin

FILTERS = "ABCDE"
STEPS = len(FILTERS)
ORDERS = ["".join(p) for p in permutations(FILTERS)]
COUNTS = ("n", "n_good", "n_toxic")


# ----------------------------------------------------------------------- failures
def _share(text: Column, kept: str) -> Column:
    """Number of characters of ``text`` that are in the set ``kept``."""
    return F.regexp_count(text, F.lit(kept))


def own_failures(text: Column) -> Column:
    """The bits of A to D, which a document's own text decides."""
    words = F.filter(F.split(F.translate(text, "\t\n\x0b\f\r", "     "), " "), lambda w: w != "")
    n_words = word_count(text)
    fails = (
        n_words < 200,
        100 * F.size(F.array_distinct(words)) < 50 * n_words,
        100 * _share(text, "[A-Z]") > 2 * F.length(text),
        text.rlike("[#$%&*|]"),
    )
    bits = F.lit(0)
    for k, failed in enumerate(fails):
        bits = bits + F.when(failed, 1 << k).otherwise(0)
    return bits


def failure_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, n_good, n_toxic): documents of each part by the filters they fail."""
    text = F.coalesce("text", F.lit(""))
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("id")).agg(
        F.coalesce(F.bool_or(F.col("quality") == 1), F.lit(False)).cast("int").alias("good"),
        F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).cast("int").alias("bad"))
    slim = docs.select(
        "doc_id", F.coalesce("source", F.lit("")).alias("part"), text.alias("text")).select(
        "doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"),
        own_failures(F.col("text")).alias("bits"))
    # Rows without an id are dealt out by their text, or they would all meet in one task.
    spread = F.when(F.col("doc_id").isNull(), F.xxhash64("digest")).otherwise(F.lit(0))
    named = slim.withColumn("spread", spread)
    marked = named.join(marks.withColumn("at", F.lit(0).cast("long")).hint("rebalance"),
                        (F.col("doc_id") == F.col("id")) & (F.col("spread") == F.col("at")), "left")
    good, bad = (F.coalesce(c, F.lit(0)).alias(c) for c in ("good", "bad"))
    # Copies become one row per part and label before they move; the second step finds how many
    # rows have the smallest id, which no smaller one precedes.
    kind = ["digest", "part", "bits", "good", "bad"]
    copies = marked.select("doc_id", "spread", "digest", "part", "bits", good, bad).groupBy(
        "doc_id", "spread", *kind).agg(F.count(F.lit(1)).alias("n")).groupBy(*kind).agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("unnamed"),
        F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("least"))
    first = F.min("least.doc_id").over(Window.partitionBy("digest"))
    alone = F.col("unnamed") + F.coalesce(
        F.when(F.col("least.doc_id") == F.col("first"), F.col("least.n")), F.lit(0))
    copy_bit = F.lit(1 << (STEPS - 1))
    split = F.array(
        F.struct(F.col("bits").alias("mask"), F.col("alone").alias("n")),
        F.struct((F.col("bits") + copy_bit).alias("mask"), (F.col("n") - F.col("alone")).alias("n")))
    return (
        copies.withColumn("first", first).withColumn("alone", alone)
        .select("part", "good", "bad", F.inline(split)).where("n > 0")
        .groupBy("part", "mask").agg(
            F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("n_good"),
            F.sum(F.col("n") * F.col("bad")).alias("n_toxic")))


# ------------------------------------------------------------------------- orders
def rank(prefix: str) -> int:
    """The Lehmer rank of the first order that begins with ``prefix``."""
    left, out = list(FILTERS), 0
    for letter in prefix:
        at = left.index(letter)
        left.pop(at)
        out += at * factorial(len(left))
    return out


def ends() -> list[tuple[int, int, int, int]]:
    """(mask, step, rank, +1 or -1): where the orders that remove a mask at a step begin and end."""
    out = []
    for mask in range(1, 2 ** STEPS):
        fails = {c for k, c in enumerate(FILTERS) if mask >> k & 1}
        for step in range(1, STEPS + 1):
            for prefix in permutations(FILTERS, step):
                if prefix[-1] in fails and not fails & set(prefix[:-1]):
                    start = rank("".join(prefix))
                    out += [(mask, step, start, 1),
                            (mask, step, start + factorial(STEPS - step), -1)]
    return out


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order and step: documents kept, removed, redundant, and what it costs."""
    spark = docs.sparkSession
    counts = pin(failure_counts(docs, labels))
    # Fixed tables: their rows follow from the number of filters alone.
    edges = F.broadcast(spark.createDataFrame(ends(), "mask int, step int, rank int, sign int"))
    grid = F.broadcast(spark.createDataFrame(
        [(r * STEPS + s - 1, r, order, s, order[s - 1])
         for r, order in enumerate(ORDERS) for s in range(1, STEPS + 1)],
        "cell int, rank int, filter_order string, step int, letter string"))
    changes = counts.join(edges, "mask").groupBy("part", "step", "rank").agg(
        *[F.sum(F.col(c) * F.col("sign")).alias(c) for c in COUNTS])
    parts = counts.groupBy("part").agg(
        F.sum("n").alias("docs"),
        *[F.sum(F.when(F.col("mask").bitwiseAND(1 << k) > 0, F.col("n")).otherwise(0))
          .alias(f"fail_{c}") for k, c in enumerate(FILTERS)],
        *[F.sum(F.when(F.col("mask") == 1 << k, F.col("n")).otherwise(0)).alias(f"only_{c}")
          for k, c in enumerate(FILTERS)])
    every = F.sequence(F.lit(0), F.lit(len(ORDERS) * STEPS - 1))
    cells = parts.select("part", F.explode(every).alias("cell")).join(grid, "cell").join(
        changes, ["part", "step", "rank"], "left")
    along = Window.partitionBy("part", "step").orderBy("rank")
    within = Window.partitionBy("part", "rank").orderBy("step")
    sums = cells.select("part", "rank", "filter_order", "step", "letter", *[
        F.sum(F.coalesce(c, F.lit(0))).over(along).alias(c) for c in COUNTS])
    sums = sums.withColumn("gone", F.sum("n").over(within)).withColumn(
        "shapley", F.sum("n").over(Window.partitionBy("part", "letter")))

    def of(kind: str) -> Column:
        return F.coalesce(*[F.when(F.col("letter") == c, F.col(f"{kind}_{c}")) for c in FILTERS])
    return sums.join(parts, "part").select(
        "part", "filter_order", "step", (F.col("docs") - F.col("gone")).alias("kept"),
        F.col("n").alias("removed"), (of("fail") - F.col("n")).alias("redundant"),
        of("only").alias("unique_fails"), F.col("n_good").alias("good_lost"),
        F.col("n_toxic").alias("toxic_lost"), "shapley")


# ------------------------------------------------------------------------ queries
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP13_SQL = r"""
with texts as (
  select doc_id, coalesce(source, '') as part, coalesce(text, '') as text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws
  from documents
), firsts as (
  select text, min(doc_id) as first from texts group by text
), failed as (
  select t.part, len(ws) < 200 as a, 100 * len(list_distinct(ws)) < 50 * len(ws) as b,
    100 * length(regexp_replace(t.text, '[^A-Z]', '', 'g')) > 2 * length(t.text) as c,
    regexp_matches(t.text, '[#$%&*|]') as d, coalesce(t.doc_id > f.first, false) as e,
    coalesce(l.quality = 1, false) as good, coalesce(l.toxic = 1, false) as bad
  from texts t join firsts f on t.text = f.text
  left join (select doc_id, max((quality = 1)::int) as quality, max((toxic = 1)::int) as toxic
             from labels group by doc_id) l on t.doc_id = l.doc_id
), masks as (
  select part, case when a then 'A' else '' end || case when b then 'B' else '' end
      || case when c then 'C' else '' end || case when d then 'D' else '' end
      || case when e then 'E' else '' end as mask,
    count(*) as n, count(*) filter (good) as n_good, count(*) filter (bad) as n_toxic
  from failed group by 1, 2
), letters as (
  select unnest(['A', 'B', 'C', 'D', 'E']) as x
), orders as (
  select a.x || b.x || c.x || d.x || e.x as filter_order
  from letters a, letters b, letters c, letters d, letters e
  where len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), cells as (
  select p.part, filter_order, step::int as step, substr(filter_order, step::int, 1) as letter
  from (select distinct part from masks) p, orders, range(1, 6) s(step)
), counted as (
  select k.part, k.filter_order, k.step, k.letter,
    sum(n)::bigint as docs,
    coalesce(sum(n) filter (gone_at < k.step), 0)::bigint as before,
    coalesce(sum(n) filter (gone_at = k.step), 0)::bigint as removed,
    coalesce(sum(n) filter (gone_at < k.step and contains(mask, k.letter)), 0)::bigint as redundant,
    coalesce(sum(n) filter (mask = k.letter), 0)::bigint as unique_fails,
    coalesce(sum(n_good) filter (gone_at = k.step), 0)::bigint as good_lost,
    coalesce(sum(n_toxic) filter (gone_at = k.step), 0)::bigint as toxic_lost
  from cells k join (
    select m.*, filter_order, case when mask = '' then 9 else list_min([
      instr(filter_order, c) for c in string_split(mask, '')]) end as gone_at
    from masks m, orders) m on m.part = k.part and m.filter_order = k.filter_order
  group by all
)
select part, filter_order, step, docs - before - removed as kept, removed, redundant, unique_fails,
  good_lost, toxic_lost, sum(removed) over (partition by part, letter)::bigint as shapley
from counted
"""
