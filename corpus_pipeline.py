"""A training corpus from raw documents, in five stages.

Each stage takes what its predecessor kept, written as Parquet and read again. Rows of ``run`` are
the packed pieces: sequence, place in it, document, tokens and text.

Null, empty and blank texts pass the filters, which find nothing in them to reject. Rows that repeat
a doc_id are kept or dropped together by the near-dedup, rows without one are kept. Documents
without tokens come with each whole epoch of their mixing leaf, those of a leaf without any tokens
not at all. Columns beyond those of documents pass all stages but the last. No documents give no rows.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from starloom.llm import line_dedup, minhash_dedup, mixing, packing, toxicity  # noqa: E402
from starloom.llm.common import table  # noqa: E402
from starloom.llm.queries import import_path  # noqa: E402
from starloom.session import pin  # noqa: E402

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    import_path(spark)
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated three-line passages go; documents that lose lines and keep only white space, too."""
    return line_dedup.drop_repeated_lines(docs, drop_emptied=True)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    import_path(spark)
    groups = minhash_dedup.near_duplicates(docs, 80)
    dropped = groups.where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(dropped, "doc_id", "left_anti")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Domains, languages and sources in their target shares; scarce ones repeat."""
    return mixing.mix(docs, mixing.by_domain_language_source())


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of the permitted lengths."""
    import_path(spark)
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", clean), ("line dedup", lines), ("MinHash near-dedup", near_copies),
    ("mixing sources to target weights", mixed), ("best-fit packing", packed),
]
#: A trained classifier and the packing order are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = pin(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
