from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from (doc_id, text) or (doc_id, text, source), with columns whose names the operators use inside."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None) for r in rows]
        df = spark.createDataFrame(full, DOCUMENTS)
        for name in ("score", "size", "hash", "sid", "n", "sketch", "spans", "base", "words", "bit", "document", "mix_hash", "mix_source", "whole", "leaving_id"):
            df = df.selectExpr("*", f"'x' AS {name}")
        return df

    return make
