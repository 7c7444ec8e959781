"""The registered queries of the subpackage and their SQL where SQL can express them."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from starloom.llm.chat import OP7_SQL, op7_chat_format
from starloom.llm.filter_audit import OP13_SQL, op13_filter_audit
from starloom.llm.hard_negatives import OP12_SQL, op12_hard_negatives
from starloom.llm.line_dedup import OP4_SQL, op4_line_dedup
from starloom.llm.line_frequency import OP3_SQL, op3_line_frequency
from starloom.llm.minhash_dedup import op9_minhash_near_dedup
from starloom.llm.mixing import mixing_sql, op8_hierarchical_mixing
from starloom.llm.packing import op10_best_fit_packing
from starloom.llm.secrets import op5_secret_scan
from starloom.llm.substring_dedup import OP11_SQL, op11_substring_dedup
from starloom.llm.token_files import op1_token_files
from starloom.llm.toxicity import op6_toxicity
from starloom.llm.vector_dedup import op2_vector_near_dedup

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {
    "op1_token_files": op1_token_files,
    "op2_vector_near_dedup": op2_vector_near_dedup,
    "op3_line_frequency": op3_line_frequency,
    "op4_line_dedup": op4_line_dedup,
    "op5_secret_scan": op5_secret_scan,
    "op6_toxicity": op6_toxicity,
    "op7_chat_format": op7_chat_format,
    "op8_hierarchical_mixing": op8_hierarchical_mixing,
    "op9_minhash_near_dedup": op9_minhash_near_dedup,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_substring_dedup": op11_substring_dedup,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_filter_audit": op13_filter_audit,
}
SQL = {"op3_line_frequency": OP3_SQL, "op4_line_dedup": OP4_SQL, "op7_chat_format": OP7_SQL,
       "op8_hierarchical_mixing": mixing_sql("documents"), "op11_substring_dedup": OP11_SQL,
       "op12_hard_negatives": OP12_SQL, "op13_filter_audit": OP13_SQL}


def import_path(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package; a cluster gets it by --py-files."""
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, (root, known)))


def registered() -> dict[str, Query]:
    def importable(query: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            import_path(spark)
            return query(spark, sf_dir)
        return run
    return {name: importable(query) for name, query in QUERIES.items()}
