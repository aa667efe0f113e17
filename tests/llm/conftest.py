from __future__ import annotations

import os
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parents[2])
# Python workers import the package too.
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use inside; a table may have them too.
CLASHING = ["version", "row", "text_", "key", "print", "found", "position", "ids", "gone", "site"]


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source), with columns of clashing names."""

    def make(rows):
        full = []
        for row in rows:
            doc_id, text, lang, source = (*row, *("en", "s0")[len(row) - 2 :]) if len(row) < 4 else row
            full.append((doc_id, text, lang, source, None if text is None else len(text)))
        df = spark.createDataFrame(full, DOCS)
        for i, name in enumerate(CLASHING):
            df = df.selectExpr("*", f"{i} AS {name}")
        return df

    return make


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_texts(spark, sf_dir):
    """All texts of the smallest tables, by id."""
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    return {row.doc_id: row.text for row in sorted(rows)}
