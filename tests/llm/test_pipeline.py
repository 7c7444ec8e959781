from __future__ import annotations

import corpus_pipeline
from starloom.llm.common import table


def test_stages_keep_the_columns_and_every_stage_decides(spark):
    folder = "/root/testdata/sf0.001"
    docs = table(spark, folder, "documents")
    before = docs.count()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert 0 < docs.select("doc_id").distinct().count() < before
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    ids = {r["doc_id"] for r in packed.select("doc_id").collect()}
    assert ids == {r["doc_id"] for r in docs.select("doc_id").collect()}


SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, row string, "
          "_tokens int, component_id int, toxicity int")


def through(spark, rows, folder="/root/testdata/sf0.001"):
    docs = spark.createDataFrame([(*r, "r", 1, 2, 3) for r in rows], SCHEMA)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == [f.split()[0] for f in SCHEMA.split(", ")]
    return docs, corpus_pipeline.STAGES[-1][1](spark, docs, folder)


def test_stages_with_nulls_repeats_and_clashing_columns(spark):
    prose = [" ".join(f"{c}{k}" for k in range(60)) for c in ("north", "south", "east")]
    lines = "first line here\nsecond line here\nthird line here"
    rows = [(1, prose[0], "en", "src0", 5), (2, prose[0], "en", "src0", 5), (3, None, "en", "src0", None),
            (4, "", "en", "src0", 0), (5, " \n ", "en", "src0", 3), (6, lines, "en", "src0", 9),
            (7, lines, "en", "src0", 9), (8, prose[1], None, None, 5), (8, prose[1], None, None, 5),
            (None, prose[2], "de", "src1", 5), (9, None, "fr", "src4", 0)]
    docs, packed = through(spark, rows)
    ids = [r["doc_id"] for r in docs.collect()]
    # 2 copies 1, 7 has lost all its lines, 8 is too long for its source's share, 9 lies in a leaf
    # without tokens
    assert set(ids) == {1, 3, 4, 5, 6, None}
    assert {r["doc_id"] for r in packed.collect()} == set(ids)


def test_stages_without_documents(spark):
    docs, packed = through(spark, [])
    assert docs.isEmpty() and packed.isEmpty()
