from __future__ import annotations

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, hi string"


@pytest.fixture(autouse=True)
def importable(spark):
    from starloom.llm.queries import import_path

    import_path(spark)


@pytest.fixture()
def documents(spark):
    """Documents with an extra column from (doc_id, text) or (doc_id, text, lang, source)."""
    def make(rows):
        full = [(r + (None, None))[:4] if len(r) < 4 else r for r in rows]
        return spark.createDataFrame(
            [(*r, len(r[1] or ""), "extra") for r in full], SCHEMA)
    return make
