from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Documents from texts, or from (doc_id, text) pairs, with columns whose names clash."""

    def make(texts, extra=True):
        rows = []
        for i, t in enumerate(texts):
            doc_id, text = t if isinstance(t, tuple) else (i, t)
            rows.append((doc_id, text, "en", f"s{i % 3}" if i % 7 else None, len(text or "")))
        df = spark.createDataFrame(rows, DOCUMENT)
        if extra:
            clashing = ("id", "digest", "body", "row", "n", "rep", "pos", "words", "score", "size", "key")
            df = df.selectExpr("*", *[f"'x' AS {name}" for name in clashing])
        return df

    return make
