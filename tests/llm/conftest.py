from __future__ import annotations

import pytest


@pytest.fixture
def docs(spark):
    """Documents as rows (doc_id, text, lang, source), with a column that may clash."""
    def make(rows, extra: str = ""):
        kind = "doc_id LONG, text STRING, lang STRING, source STRING"
        if extra:
            rows, kind = [(*r, "other") for r in rows], f"{kind}, {extra} STRING"
        return spark.createDataFrame(rows, kind)

    return make
