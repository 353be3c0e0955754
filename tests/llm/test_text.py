"""Quality rules, decontamination, licences and encoding."""

from __future__ import annotations

import base64
import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tidemark.llm import byte_bpe, decontamination, licenses, quality

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    rng = random.Random(4)
    letters = [chr(code) for code in (*range(0x250), 0x3B1, 0x431, 0x5D0, 0x661, 0x4E00, 0x1F600, 0x200D, 0x2028, 0x85, 0xFEFF)]
    made = ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(300)]
    made += [each * times for each in ("a", "-", " ", "ab", "é", "#", "日", "\n", " x") for times in (1, 2, 3, 7, 64, 333)]
    return made + ["", "it's  a <|endoftext|> text\n\n\tend ", "word " * 5000]


def test_encoding_equals_the_rank_library(docs, reference):
    pairs = [*enumerate(texts()), (9999, None), (9998, "twice"), (9998, "twice")]
    expected = Counter()
    for doc_id, text in pairs:
        ids = reference.encode_ordinary(text or "")
        packed = np.array(ids, "<u4").tobytes()
        expected[doc_id, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()] += 1
    assert Counter(tuple(row) for row in byte_bpe.round_trip(docs(pairs), RANKS, PATTERN).collect()) == expected


def test_offsets_and_decoding(docs, reference):
    pairs = [(1, "naïve 日本語 😀"), (2, None), (3, "")]
    rows = {row.doc_id: row for row in byte_bpe.encode(docs(pairs), RANKS, PATTERN).collect()}
    text, row = pairs[0][1], rows[1]
    pieces = [reference.decode_single_token_bytes(each) for each in row.ids]
    assert row.byte_starts == [len(b"".join(pieces[:at])) for at in range(len(pieces))]
    assert row.char_starts == [len(text.encode()[:start].decode(errors="ignore")) for start in row.byte_starts]
    assert rows[2].ids == rows[3].ids == []
    decoded = byte_bpe.decode(byte_bpe.encode(docs(pairs), RANKS, PATTERN), RANKS, PATTERN)
    assert {row.doc_id: bytes(row.bytes).decode() for row in decoded.collect()} == {1: text, 2: "", 3: ""}


def test_remembered_pieces_are_bounded(monkeypatch, reference):
    monkeypatch.setattr(byte_bpe, "REMEMBERED_PIECES", 10)
    tool = byte_bpe.ByteBpe(RANKS, PATTERN)
    made = texts()
    assert [np.frombuffer(each, "<u4").tolist() for each in tool.encode(made)] == [reference.encode_ordinary(each) for each in made]


def test_counts_of_the_quality_rules(docs):
    pairs = [
        (1, None),
        (2, ""),
        (3, " \t\n"),
        (4, "one #two\r\n\nsame line\nsame line \nsame line"),
        (5, "a b c a b c a"),
        (6, "w " * 60),
        (7, "x\x0by é z"),
        (8, "p q r s p q r"),
        (8, "p q r s p q r"),
    ]
    rows = quality.judged(docs(pairs)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert sorted(tuple(row) for row in rows.collect()) == [
        (1, 0, 0, 0, 0, 0, True),
        (2, 0, 0, 0, 0, 0, True),
        (3, 0, 0, 0, 0, 0, True),
        (4, 8, 31, 1, 1, 6, True),
        (5, 7, 7, 0, 0, 7, True),
        (6, 60, 60, 0, 0, 60, True),
        (7, 3, 5, 0, 0, 0, True),
        (8, 7, 7, 0, 0, 6, True),
        (8, 7, 7, 0, 0, 6, True),
    ]


def test_odd_histograms_are_rejected_and_clean_ones_kept(docs, spark):
    rng = random.Random(8)
    common = quality.COMMON_WORDS["en"]
    vocabulary = ["".join(rng.choice("aeinorst") for _ in range(rng.randrange(3, 9))) for _ in range(3000)]

    def prose(words, share=0.4):
        return " ".join(rng.choice(common) if rng.random() < share else rng.choice(vocabulary) for _ in range(words))

    clean = [(number, prose(200) + ".") for number in range(60)]
    odd = [(100, prose(200).upper().replace(" ", "!! ")), (101, prose(200).replace(" ", "%%% ")), (102, prose(200, 0.0))]
    frame = docs([*clean, *odd, (103, prose(20))])
    assert {row.doc_id for row in quality.kept_documents(frame).collect()} == set(range(60))
    assert quality.kept_documents(frame).columns == frame.columns
    unknown = frame.withColumn("lang", F.lit(None).cast("string"))
    assert {row.doc_id for row in quality.kept_documents(unknown).collect()} == {*range(60), 100, 101, 102}
    assert quality.kept_documents(frame.where("doc_id < 0")).count() == 0


def test_rules_take_filters_and_any_column_names(docs):
    words = " ".join(["the of and word"] * 5 + [f"w{at}" for at in range(60)])
    frame = docs([(1, words), (2, "short"), (3, None)]).withColumnsRenamed({"firsts": "classes", "leaks": "n_words", "vertex": "reference_classes"})
    rows = quality.judged(frame)
    assert {row.doc_id for row in rows.where("kept").collect()} == {1}
    assert {row.doc_id for row in rows.where("base_failed AND n_words < 2").collect()} == {2, 3}
    assert rows.first().reference_classes == 3 and rows.columns.count("n_words") == 1
    kept = quality.kept_documents(frame)
    assert kept.columns == frame.columns and kept.first().n_words == 2


def brute_leaks(pairs, items):
    index = decontamination.ItemIndex(items, decontamination.LEAST_SCORE)
    found = set()
    for doc_id, text in pairs:
        words = decontamination.words_of(text or "")
        for start in range(0, max(1, len(words) - index.stride), index.stride):
            passage = words[start : start + 2 * index.stride]
            here = {index.terms[word] for word in passage if word in index.terms}
            for item, item_id in enumerate(index.ids):
                score = sum(w for term in here for at, w in zip(index.items_of[term], index.weights_of[term]) if at == item)
                if score < index.least:
                    continue
                shares = []
                for part in index.parts[item]:
                    size = min(decontamination.NGRAM, len(part))
                    own = {tuple(part[at : at + size]) for at in range(len(part) - size + 1)}
                    have = {tuple(passage[at : at + size]) for at in range(len(passage) - size + 1)}
                    shares.append(len(own & have) / len(own))
                if min(shares) >= decontamination.LEAST_OVERLAP:
                    found.add((doc_id, item_id))
    return found


@pytest.mark.parametrize("blocks", [1, 3])
def test_leaks_equal_a_full_search(docs, spark, blocks, monkeypatch):
    rng = random.Random(2)
    vocabulary = [f"word{number}" for number in range(400)] + ["the", "of", "and"] * 30

    def prose(words):
        return " ".join(rng.choice(vocabulary) for _ in range(words))

    items = [(number, f"{prose(rng.randrange(5, 40))}. {prose(6)}?") for number in range(60)] + [(900, None), (901, ""), (902, "...")]
    items += [(903, items[3][1]), (None, items[7][1])]
    pairs = [(number, prose(rng.randrange(0, 600))) for number in range(40)]
    pairs += [(100 + number, f"{prose(rng.randrange(300))} {items[number][1].upper()} {prose(100)}") for number in range(20)]
    pairs += [(200 + number, f"{prose(80)} {items[number][1].split('. ')[0]} {prose(80)}") for number in range(20, 30)]
    pairs += [(300, None), (301, ""), (302, items[5][1]), (302, items[5][1]), (None, items[6][1])]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    at_once = {(row.doc_id, row.item_id): row.score for row in decontamination.leaks(docs(pairs), benchmark).collect()}
    if blocks > 1:
        monkeypatch.setattr(decontamination, "MOST_WORDS", sum(len(text or "") for _, text in items) // 6 // blocks)
        assert decontamination.item_blocks(benchmark, "item_id", "text")[0] > 1
    found = {(row.doc_id, row.item_id): row.score for row in decontamination.leaks(docs(pairs), benchmark).collect()}
    assert found == pytest.approx(at_once)
    found = set(found)
    assert found == brute_leaks(pairs, [item for item in items if item[1]])
    assert {(100 + number, number) for number in range(20)} <= found
    assert {(103, 903), (302, 5), (None, 6), (107, None), (107, 7)} <= found
    assert not any(doc_id is not None and (doc_id < 100 or 200 <= doc_id < 300) for doc_id, _ in found)
    clean = decontamination.without_leaks(docs(pairs), benchmark)
    assert clean.columns == docs(pairs).columns
    assert Counter(row.doc_id for row in clean.collect()) == Counter(doc_id for doc_id, _ in pairs if doc_id not in {each for each, _ in found})
    assert decontamination.leaks(docs(pairs), benchmark.where("item_id < 0")).count() == 0


def test_licences(docs):
    pairs = [
        (1, "code\nReleased under the MIT license!\nmore"),
        (2, "This work is licensed under the GNU General Public License, version 2."),
        (3, "released under the license"),
        (4, None),
        (5, ""),
        (6, "word"),
        (7, "Released under the MIT License. " * 50),
        (8, "Licensed under CC BY-NC 4.0.\n" * 2),
    ]
    found = licenses.best_by_paragraph(licenses.license_matches(docs(pairs)))
    rows = sorted((row.doc_id, row.unit_no, row.licence, row.dice_permille) for row in found.collect())
    assert rows[:2] == [(1, 1, "MIT", 1000), (2, 0, "GPL-2.0", 1000)]
    assert (7, 0, "MIT") in {row[:3] for row in rows}
    assert rows[-2:] == [(8, 0, "CC-BY-NC-4.0", 1000), (8, 1, "CC-BY-NC-4.0", 1000)]
    assert {row[0] for row in rows} == {1, 2, 7, 8}
