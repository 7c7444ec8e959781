"""Mixing to target weights: a token budget handed down a domain - language - source tree.

A node's budget goes to its children by weight, none above what its documents can give in
``max_epochs`` passes (documents under an excluded value give nothing). What a child cannot use goes to its siblings by weight; only when a whole
subtree falls short does its own parent pass the rest on. That is settled level by level in closed
form: children are ordered by how early they run out, and running sums tell how many of them do.
All of it is in whole numbers, so a level may leave a token per child unspent.

A leaf's stream is one seeded order of its documents after the other (order by md5 of seed, epoch
and doc_id). It takes whole epochs, and of the next one the longest run of whole documents from the
start that fits. The last hash that fits is found from token sums per hash prefix, again for longer
prefixes under the one that was found as long as the largest leaf asks for, then among the documents
of one prefix: no leaf is ever sorted as a whole, and texts are never shuffled.

Tokens are words. Null levels are values of their own; null and empty texts have no tokens and come
with each whole epoch. Documents of a leaf without tokens are taken 0 times. Rows that repeat a doc_id
within a leaf share a place in the order and are taken or left together. Unlisted values weigh 1,
a weight of 0 excludes. Rows are carried as structs, so names of columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.llm.common import table, word_count
from starloom.session import pin

#: Hash digits that one step of the search looks at, and rows that may share what it finds.
PREFIX, MOST_ROWS = 3, 100_000
LEVELS = ("_l0", "_l1", "_l2")
WEIGHTS = ({"domain0": 5, "domain1": 3, "domain2": 2}, {"en": 6, "de": 3, "fr": 3, "es": 2}, {})
SHARE, MAX_EPOCHS, SEED = 100, 4, 11


def domain_of(source: Column) -> Column:
    """The benchmark sources dealt into three domains by their number; null without one."""
    number = F.regexp_extract(source, r"^src([0-9]{1,9})$", 1)
    return F.when(number != "", F.concat(F.lit("domain"), (number.cast("int") % 3).cast("string")))


def _weight(value: Column, weights: Mapping[str, int]) -> Column:
    out = F.lit(1)
    for name, w in weights.items():
        out = F.when(value == name, w).otherwise(out)
    return out.cast("long")


def _same(a: DataFrame, b: DataFrame, columns: Sequence[str]) -> Column:
    """Equal in all columns, null counting as a value."""
    on = F.lit(True)
    for c in columns:
        on = on & a[c].eqNullSafe(b[f"{c}_"])
    return on


def _renamed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed({c: f"{c}_" for c in columns})


def allot(leaves: DataFrame, weights: Sequence[Mapping[str, int]], share: int,
          max_epochs: int) -> DataFrame:
    """(levels, tokens, target) per leaf, from (levels, tokens)."""
    open_leaf = F.lit(True)
    for level, of_level in zip(LEVELS, weights, strict=True):
        open_leaf = open_leaf & (_weight(F.col(level), of_level) > 0)
    leaves = leaves.withColumn("usable", F.when(open_leaf, F.col("tokens")).otherwise(0))
    above = leaves.agg((F.sum("tokens") * share).alias("budget")).select(
        F.expr("budget div 100").alias("budget"))
    for depth, level in enumerate(LEVELS, 1):
        parent = list(LEVELS[:depth - 1])
        nodes = leaves.groupBy(*LEVELS[:depth]).agg(
            (F.sum("usable") * max_epochs).alias("cap")).withColumn(
            "w", _weight(F.col(level), weights[depth - 1]))
        up = _renamed(above, parent)
        siblings = Window.partitionBy(*parent)
        order = siblings.orderBy(F.coalesce(F.try_divide(F.col("cap").cast("double"), F.col("w")),
                                            F.lit(1e300)), level)
        order = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        before = F.sum("cap").over(order) - F.col("cap")
        rest = F.sum("w").over(siblings) - F.sum("w").over(order) + F.col("w")
        full = (F.col("budget") - F.col("before")) * F.col("w") >= F.col("cap") * F.col("rest")
        spent = F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(siblings), F.lit(0))
        open_w = F.coalesce(F.sum(F.when(~F.col("full"), F.col("w"))).over(siblings), F.lit(0))
        above = (
            nodes.join(up, _same(nodes, up, parent)).withColumns({"before": before, "rest": rest})
            .withColumn("full", full).withColumns({"spent": spent, "open_w": open_w})
            .withColumn("part", F.expr("if(open_w > 0, ((budget - spent) * w) div open_w, 0)"))
            .select(*LEVELS[:depth], F.when(F.col("full"), F.col("cap")).otherwise(
                F.greatest(F.col("part"), F.lit(0))).alias("budget")))
    targets = _renamed(above, LEVELS)
    return leaves.join(targets, _same(leaves, targets, LEVELS)).select(
        *LEVELS, "tokens", F.col("budget").alias("target"))


def _order(seed: int) -> Column:
    doc_id = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col("_full").cast("string"), F.lit(":"), doc_id))


def _last_hashes(hashed: DataFrame, leaf: list[str], steps: int) -> DataFrame:
    """(leaf, _last): the last hash up to which the documents of a leaf fit into ``_rest`` tokens."""
    cut = None
    for step in range(1, steps + 1):
        prefix = F.substring("h", 1, PREFIX * step)
        before = F.lit(0).cast("long")
        inside = hashed
        if cut is not None:
            inside = _inside(hashed, cut, leaf, PREFIX * (step - 1))
            before = F.first("cut.before")
        sums = inside.groupBy(*leaf, "_rest", prefix.alias("prefix")).agg(
            F.sum("tokens").alias("tokens"), before.alias("start"))
        so_far = Window.partitionBy(*leaf).orderBy("prefix").rowsBetween(
            Window.unboundedPreceding, Window.currentRow)
        found = sums.withColumn("end", F.col("start") + F.sum("tokens").over(so_far)).where(
            F.col("end") > F.col("_rest")).groupBy(*leaf).agg(F.min(F.struct(
                "prefix", (F.col("end") - F.col("tokens")).alias("before"))).alias("cut"))
        cut = _renamed(pin(found), leaf)
    at = _inside(hashed, cut, leaf, PREFIX * steps)
    ends = F.sum("tokens").over(Window.partitionBy(*leaf).orderBy("h")) + F.col("cut.before")
    return (at.withColumn("fits", ends <= F.col("_rest")).groupBy(*leaf, "cut")
            .agg(F.max(F.when(F.col("fits"), F.col("h"))).alias("h"))
            .select(*leaf, F.coalesce("h", F.col("cut.prefix")).alias("_last")))


def _inside(hashed: DataFrame, cut: DataFrame, leaf: list[str], digits: int) -> DataFrame:
    return hashed.join(cut, _same(hashed, cut, leaf)).where(
        F.substring("h", 1, digits) == F.col("cut.prefix"))


def steps_for(rows: int) -> int:
    """Steps of the search after which about ``MOST_ROWS`` rows are left of the largest leaf."""
    steps = 1
    while rows > MOST_ROWS * 16 ** (PREFIX * steps):
        steps += 1
    return steps


def with_copies(docs: DataFrame, levels: Sequence[Column],
                weights: Sequence[Mapping[str, int]] = WEIGHTS, share: int = SHARE,
                max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """(row, three levels, _tokens, _copies): every row as a struct, and how often it is taken."""
    placed = docs.select(
        F.struct("*").alias("row"), *[c.alias(n) for n, c in zip(LEVELS, levels, strict=True)],
        word_count(F.col("text")).alias("_tokens"), F.col("doc_id").alias("doc_id"))
    slim = pin(placed.select("doc_id", *LEVELS, F.col("_tokens").alias("tokens")))
    leaves = pin(slim.groupBy(*LEVELS).agg(
        F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")))
    # One row per leaf from here on, read from written tables, so Spark knows their size and
    # broadcasts them while they are small.
    targets = _renamed(pin(allot(leaves.drop("rows"), weights, share, max_epochs)
                           .where("tokens > 0").select(
        *LEVELS, F.expr("target div tokens").alias("_full"),
        F.expr("target % tokens").alias("_rest"))), LEVELS)
    leaf = [f"{c}_" for c in LEVELS]

    hashed = slim.join(targets, _same(slim, targets, LEVELS)).select(
        *leaf, "_full", "_rest", "tokens", _order(seed).alias("h"))
    largest = leaves.agg(F.max("rows")).first()[0] or 0
    last = _renamed(_last_hashes(hashed, leaf, steps_for(largest)), leaf)
    taken = pin(targets.join(last, _same(targets, last, leaf), "left").select(
        *leaf, "_full", F.when(F.col("_rest") > 0, F.col("_last")).alias("_last")))
    part = F.coalesce(_order(seed) <= F.col("_last"), F.lit(False)).cast("long")
    return placed.join(taken, _same(placed, taken, LEVELS), "left").select(
        "row", *LEVELS, "_tokens",
        F.coalesce(F.col("_full") + part, F.lit(0).cast("long")).alias("_copies"))


def mix(docs: DataFrame, levels: Sequence[Column], **options) -> DataFrame:
    """``docs`` with each row as often as it is taken, columns as they came."""
    return with_copies(docs, levels, **options).where("_copies > 0").select(
        "row", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(
        *[F.col("row")[c].alias(c) for c in docs.columns])


# --------------------------------------------------------------------- queries
def by_domain_language_source() -> list[Column]:
    return [domain_of(F.col("source")), F.col("lang"), F.col("source")]


def op8_hierarchical_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return with_copies(docs, by_domain_language_source()).select(
        "row.doc_id", F.col("_l0").alias("domain"), "row.lang", "row.source",
        F.col("_tokens").alias("n_tokens"), F.col("_copies").alias("n_copies"))


def mixing_sql(docs: str, share: int = SHARE, max_epochs: int = MAX_EPOCHS,
               seed: int = SEED) -> str:
    """DuckDB SQL for (doc_id, domain, lang, source, n_tokens, n_copies) of the relation ``docs``."""
    def weight(value: str, weights: Mapping[str, int]) -> str:
        cases = " ".join(f"when {value} = '{k}' then {w}" for k, w in weights.items())
        return f"case {cases} else 1 end" if cases else "1"

    steps, on = [], "true"
    for depth, level in enumerate(("domain", "lang", "source"), 1):
        names = ("domain", "lang", "source")[:depth]
        group, parent = ", ".join(names), ", ".join(f"n.{c}" for c in names[:-1])
        part = f"partition by {parent}" if parent else ""
        steps.append(f"""
nodes{depth} as (
  select {group}, (sum(usable) * {max_epochs})::hugeint as cap,
         ({weight(level, WEIGHTS[depth - 1])})::hugeint as w from leaves group by {group}
), filled{depth} as (
  select n.*, p.budget,
    sum(cap) over ({part} order by cap::double / w, n.{level} nulls first
                   rows unbounded preceding) - cap as before,
    sum(w) over ({part}) - sum(w) over ({part} order by cap::double / w, n.{level} nulls first
                                        rows unbounded preceding) + w as rest
  from nodes{depth} n join budget{depth - 1} p on {on}
), marked{depth} as (
  select *, (budget - before) * w >= cap * rest as fill from filled{depth}
), budget{depth} as (
  select {group}, case when fill then cap else greatest(0,
    (budget - coalesce(sum(case when fill then cap end) over ({part}), 0)) * w
    // nullif(sum(case when fill then 0 else w end) over ({part}), 0)) end as budget
  from marked{depth} n
)""")
        on += f" and n.{level} is not distinct from p.{level}"
    usable = " and ".join(f"({weight(c, WEIGHTS[k])}) > 0"
                          for k, c in enumerate(("domain", "lang", "source")))
    return f"""
with placed as (
  select doc_id, lang, source,
    case when regexp_matches(source, '^src[0-9]{{1,9}}$')
         then 'domain' || (substr(source, 4)::int % 3) end as domain,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint as tokens
  from {docs}
), leaves as (
  select domain, lang, source, sum(tokens)::hugeint as tokens,
    case when {usable} then sum(tokens) else 0 end::hugeint as usable from placed
  group by domain, lang, source
), budget0 as (
  select (sum(tokens) * {share}) // 100 as budget from leaves
), {",".join(steps)},
targets as (
  select n.*, p.budget // n.tokens as whole, p.budget % n.tokens as part
  from leaves n join budget3 p on {on} where n.tokens > 0
), ordered as (
  select p.*, n.whole, n.part, md5('{seed}:' || n.whole || ':' || coalesce(p.doc_id::varchar, '')) as h
  from placed p left join targets n on {on}
)
select doc_id, domain, lang, source, tokens as n_tokens,
  coalesce(whole + case when part > 0 and sum(tokens) over (
     partition by domain, lang, source order by h) <= part then 1 else 0 end, 0)::bigint as n_copies
from ordered
"""
