from __future__ import annotations

from pathlib import Path

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, firsts int, kept string, leaks int, vertex int"


@pytest.fixture(scope="session", autouse=True)
def package_on_workers(spark):
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) pairs, with extra columns named like ones the operators use."""

    def make(pairs, lang="en"):
        rows = [(doc_id, text, lang, None, None, 1, "x", 2, 3) for doc_id, text in pairs]
        return spark.createDataFrame(rows, DOCS).repartition(3)

    return make
