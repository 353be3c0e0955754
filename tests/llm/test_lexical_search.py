"""Ranked search by brute force: ties, copies, blocks, pilots, split trees."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import lexical_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return TERM.findall("".join(chr(ord(each) + 32) if "A" <= each <= "Z" else each for each in text or ""))


def ranked(docs, items, k=10):
    held = [(doc_id, words(text)) for doc_id, text in docs]
    held = [(doc_id, Counter(terms), len(terms)) for doc_id, terms in held if terms]
    total, number = sum(n for _, _, n in held), len(held)
    found = Counter(term for _, terms, _ in held for term in terms)
    result = Counter()
    for item_id, text in items:
        scores = []
        for doc_id, terms, n in held:
            m = 10 + 90 * n * number // total
            score = 0
            for term in set(words(text)) & set(terms):
                weight = math.floor(1000 * math.log((2 * number + 2) / (2 * found[term] + 1)))
                score += weight * (10**9 * terms[term] // (1000 * terms[term] + 8 * m))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0))
        for rank, (score, missing, doc_id) in enumerate(sorted(scores)[:k], 1):
            result[item_id, rank, None if missing else doc_id, -score] += 1
    return result


def corpus(seed=12, size=400):
    rng = random.Random(seed)
    vocabulary = ["the", "Of", "né", "日本", "x1"] + [f"w{at}" for at in range(150)]
    share = [1 / (at + 1) for at in range(len(vocabulary))]

    def text(most):
        return rng.choice(" \n.") .join(rng.choices(vocabulary, share, k=rng.randrange(most)))

    docs = [(at, text(60)) for at in range(size)]
    docs += [(1000 + at, docs[7][1]) for at in range(30)]  # copies tie
    docs += [(7, docs[7][1]), (None, docs[7][1]), (2000, None), (2001, ""), (2002, " .. "), (2003, "w1 " * 20_000)]
    items = [(at, text(25)) for at in range(40)]
    items += [(50, docs[7][1]), (51, docs[7][1]), (51, "né"), (52, None), (53, ""), (54, "nowhere"), (None, "w3 w4"), (55, docs[7][1].upper())]
    return docs, items


@pytest.fixture
def frames(spark, docs):
    made, items = corpus()
    benchmark = spark.createDataFrame([(*each, 1) for each in items], "item_id bigint, text string, doc_id int")
    return docs(made), benchmark, ranked(made, items)


def found(docs, items, **options):
    rows = lexical_search.ranked_documents(docs, items, **options).select("item_id", "rank", "doc_id", "score")
    return Counter(map(tuple, rows.collect()))


def test_equals_brute_force(frames):
    docs, items, expected = frames
    assert found(docs, items) == expected


def test_pilot_and_blocks_change_nothing(frames, monkeypatch):
    docs, items, expected = frames
    monkeypatch.setattr(lexical_search, "PILOT_DOCUMENTS", 100)
    monkeypatch.setattr(lexical_search, "BLOCK_BYTES", 1500)
    assert found(docs, items) == expected


def test_empty_tables_and_clashing_names(frames):
    docs, items, expected = frames
    assert not found(docs.limit(0), items) and not found(docs, items.limit(0))
    clashing = docs.withColumnRenamed("kept", "score").withColumnRenamed("leaks", "terms").withColumnRenamed("firsts", "item")
    assert found(clashing, items.withColumnRenamed("doc_id", "digest")) == expected


@pytest.mark.parametrize("tree, cells", [(1024, 1 << 22), (37, 1 << 22), (1024, 500)])
def test_trees_leave_out_pairs_but_no_result(monkeypatch, tree, cells):
    monkeypatch.setattr(lexical_search, "TREE", tree)
    monkeypatch.setattr(lexical_search, "CELLS", cells)
    rng = np.random.default_rng(3)
    topics = 30  # documents and items of a topic share rare terms
    width, size = topics * 10, 1500
    of = rng.integers(0, topics, size)
    rows = np.repeat(np.arange(size), 6)
    terms = (of[rows] * 10 + np.tile(rng.permuted(np.tile(np.arange(10), (size, 1)), axis=1)[:, :6], 1).ravel()).astype(np.int64)
    values = rng.integers(1, 1000, len(rows))
    items = [np.sort(rng.choice(10, 5, replace=False)) + 10 * (at % topics) for at in range(90)]
    frequency = np.bincount(terms, minlength=width)
    search = lexical_search.Search(lexical_search.ItemTree(items, frequency), width, 10, np.zeros(len(items), np.int64))
    scored = []
    take = search._take
    monkeypatch.setattr(search, "_take", lambda item, ids, scores: (scored.extend(ids), take(item, ids, scores)))
    search.show(list(range(size)), rows, terms, values)
    full = np.zeros((size, width), np.int64)
    full[rows, terms] = values
    expected = set()
    for item, own in enumerate(items):
        scores = full[:, own].sum(axis=1)
        best = sorted((-score, at) for at, score in enumerate(scores.tolist()) if score > 0)[:10]
        expected |= {(item, at, -score) for score, at in best}
    assert set(search.found()) == expected
    assert len(scored) < size * len(items) / 10
