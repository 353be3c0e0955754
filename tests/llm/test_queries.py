"""Registered text queries: beside their SQL, and the pipeline stage by stage."""

from __future__ import annotations

import re
from pathlib import Path

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from check_oracles import connect, differences
from tidemark.llm.common import stored, table
from tidemark.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no driver tables here")


def test_all_are_registered():
    assert {f"op{number}" for number in range(1, 14)} == {name.split("_")[0] for name in QUERIES}
    assert {*QUERIES, "pipeline"} <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    assert differences(QUERIES[name](spark, FOLDER), connect(FOLDER), ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_of_the_others(spark, name):
    rows = QUERIES[name](spark, FOLDER).count()
    source = "pages" if name.startswith(("op3", "op6")) else "documents"
    assert rows == table(spark, FOLDER, source).count() or name.startswith("op1_")


def test_leaks_are_the_planted_items(spark):
    found = {(row.doc_id, row.item_id) for row in QUERIES["op1_decontamination"](spark, FOLDER).collect()}
    connection = connect(FOLDER)
    planted = connection.execute("SELECT doc_id, item_id FROM documents d JOIN benchmark b ON contains(d.text, b.text)").fetchall()
    assert found == set(planted)


def test_pipeline_stages(spark):
    docs = table(spark, FOLDER, "documents")
    kept = {row.doc_id for row in QUERIES["op2_quality_rules"](spark, FOLDER).where("kept").collect()}
    frames = [docs]
    for _, stage in corpus_pipeline.STAGES:
        frames.append(stored(stage(spark, frames[-1], FOLDER)))
    for frame in frames[1:-1]:
        assert frame.columns == docs.columns
    ids = [{row.doc_id for row in frame.select("doc_id").collect()} for frame in frames]
    assert ids[1] == kept
    sets = {}
    for row in frames[1].collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), row.text))
        sets[row.doc_id] = {tuple(words[at : at + 5]) for at in range(len(words) - 4)}
    for doc_id in ids[1] - ids[2]:  # something like it, with a smaller id, was there
        assert any(other < doc_id and 100 * len(sets[doc_id] & own) >= 60 * len(sets[doc_id] | own) for other, own in sets.items())
    for a in ids[2]:
        for b in ids[2]:
            assert a <= b or 100 * len(sets[a] & sets[b]) < 80 * len(sets[a] | sets[b])
    assert ids[3] == ids[2]
    assert all(row.n_chars == len(row.text) for row in frames[3].collect())
    items = [row.text for row in table(spark, FOLDER, "benchmark").collect()]
    leaking = {row.doc_id for row in frames[3].collect() if any(item in row.text for item in items)}
    assert ids[4] == ids[3] - leaking
    assert ids[5] == ids[4]
    assert corpus_pipeline.run(spark, FOLDER).count() == len(ids[5])
