"""Fixtures for the training-data operators: a session whose workers can import the package."""

import os
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parents[2])
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
EXTRA = ", head long, key string, band long, root long, node long, size long, label string, curve long, _id long"


@pytest.fixture
def documents(spark):
    """Builds a documents table from texts, or from (doc_id, text) pairs, with clashing extra columns on wish."""

    def build(texts, extra=False, **columns):
        rows = []
        for i, item in enumerate(texts):
            doc_id, text = item if isinstance(item, tuple) else (i, item)
            row = [doc_id, text, "en", "src0", None if text is None else len(text)]
            rows.append(tuple(row + ([7, "x", 7, 7, 7, 7, "x", 7, 7] if extra else [])))
        df = spark.createDataFrame(rows, DOCUMENTS + (EXTRA if extra else ""))
        return df.withColumns(columns) if columns else df

    return build


@pytest.fixture
def rows():
    """Rows of a frame as dictionaries by id."""

    def collect(df, key="doc_id"):
        found = {}
        for row in df.collect():
            found.setdefault(row[key], []).append(row.asDict())
        return {k: v[0] if len(v) == 1 else v for k, v in found.items()}

    return collect
