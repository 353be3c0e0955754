"""Near copies, repeated strings, repeated lines: against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter
from itertools import permutations
from pathlib import Path

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import ngram_join, repeated_spans
from tidemark.llm.blocks import SubstringHashes
from tidemark.llm.components import components
from tidemark.llm.line_dedup import kept_text, sql, without_repeated_lines
from tidemark.llm.queries import QUERIES

WORDS = "ant bee cat dog elk fox gnu hen ibis jay kite lark mole newt owl pig quail ram seal toad".split()


def prose(rng, words):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(words))


def edited(rng, text, edits):
    words = text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def brute_components(pairs):
    sets = []
    for _, text in pairs:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        grams = {tuple(words[at : at + 5]) for at in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()
        sets.append(grams)
    root = list(range(len(pairs)))

    def find(at):
        while root[at] != at:
            at = root[at]
        return at

    for a in range(len(pairs)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                root[find(a)] = find(b)
    ids = {}
    for at, (doc_id, _) in enumerate(pairs):
        ids.setdefault(find(at), []).append(doc_id)
    smallest = {top: min((each for each in every if each is not None), default=None) for top, every in ids.items()}
    return sorted(((doc_id, len(sets[at]), smallest[find(at)]) for at, (doc_id, _) in enumerate(pairs)), key=str)


def corpus(seed=5):
    rng = random.Random(seed)
    base = prose(rng, 120)
    pairs = [(number, prose(rng, rng.randrange(1, 90))) for number in range(40)]
    passage = prose(rng, 60)
    pairs += [(100 + number, f"{prose(rng, 30)} {passage} {prose(rng, 30)}") for number in range(40)]
    pairs += [(200 + number, edited(rng, base, rng.randrange(0, 6))) for number in range(60)]
    pairs += [(300, "One  Two\tthree"), (301, "one two three"), (302, "one two"), (303, ""), (304, None), (305, " \n"), (306, None)]
    pairs += [(400, base), (400, base), (401, base.upper()), (None, base), (None, prose(rng, 20))]
    return pairs


def test_components_equal_brute_force(docs):
    pairs = corpus()
    result = ngram_join.ngram_components(docs(pairs))
    assert sorted((tuple(row) for row in result.collect()), key=str) == brute_components(pairs)


def test_components_do_not_depend_on_what_counts_as_frequent(docs, monkeypatch):
    """Family comparison and pair comparison give the same links."""
    pairs = corpus(6)
    monkeypatch.setattr(ngram_join, "FREQUENT", 3)
    monkeypatch.setattr(ngram_join, "STARS", 1)
    monkeypatch.setattr(ngram_join, "GRAMS_PER_BLOCK", 700)
    result = ngram_join.ngram_components(docs(pairs))
    assert sorted((tuple(row) for row in result.collect()), key=str) == brute_components(pairs)


def test_one_of_each_group_stays(docs):
    pairs = corpus(7)
    frame = docs(pairs)
    kept = ngram_join.without_near_copies(frame)
    assert kept.columns == frame.columns
    expected = Counter()
    by_component = {}
    for doc_id, size, component in brute_components(pairs):
        if size:
            by_component.setdefault(component if component is not None else "unnamed", doc_id)
        else:
            expected[doc_id] += 1
    expected.update(component if component != "unnamed" else None for component in by_component)
    assert Counter(row.doc_id for row in kept.collect()) == expected


def test_empty_tables(docs, spark):
    empty = docs([(1, "x")]).where("doc_id > 1")
    assert ngram_join.ngram_components(empty).count() == 0
    assert ngram_join.without_near_copies(empty).count() == 0
    assert repeated_spans.span_digests(empty).count() == 0
    assert repeated_spans.without_repeats(empty).count() == 0
    assert without_repeated_lines(empty).count() == 0


def test_tree_walk_equals_set_overlap():
    rng = np.random.default_rng(3)
    own = np.unique(rng.integers(0, 60, 40).astype(np.uint64))
    others = [np.unique(rng.integers(0, 60, rng.integers(1, 60)).astype(np.uint64)) for _ in range(300)]
    others += [own, own[:-3], own[2:], own[:5]]
    expected = [100 * len(set(own) & set(each)) >= 80 * len(set(own) | set(each)) for each in others]
    assert ngram_join.linked_in_tree(own, others, 80) == expected
    assert sum(expected) >= 3


def test_sketches_never_overstate_the_difference():
    rng = np.random.default_rng(11)
    for size in (1, 2, 9, 100, 1000):
        own = np.unique(rng.integers(0, 1 << 64, size, dtype=np.uint64))
        for gone, fresh in ((0, 0), (1, 0), (0, 1), (size // 10, size // 7), (size, 3 * size)):
            other = np.union1d(own[gone:], rng.integers(0, 1 << 64, fresh, dtype=np.uint64))
            difference = len(np.setxor1d(own, other))
            for a, b in ((own, other), (other, own)):
                least = ngram_join.least_difference(ngram_join.sketch(a), ngram_join.sketch(b))
                assert least <= difference and least % 2 == difference % 2
        unlike = np.unique(rng.integers(0, 1 << 64, size, dtype=np.uint64))
        if size >= 100:
            assert ngram_join.least_difference(ngram_join.sketch(own), ngram_join.sketch(unlike)) > size // 2


def test_join_leaves_two_tables(docs, spark):
    """What stays in the shared folder is what the result reads."""
    from tidemark.llm.common import work_folder

    folder = Path(work_folder(spark).removeprefix("file:")).parent
    before = set(folder.glob("*")) if folder.exists() else set()
    result = ngram_join.ngram_components(docs(corpus(8)))
    assert len(set(folder.glob("*")) - before) == 2
    assert sorted((tuple(row) for row in result.collect()), key=str) == brute_components(corpus(8))


def test_components_of_chains_and_stars(spark):
    links = [(at, at + 1) for at in range(0, 60)] + [(100, 200 + at) for at in range(40)] + [(7, 7)]
    result = components(spark.createDataFrame(links, "a bigint, b bigint").repartition(7))
    found = {row.vertex: row.root for row in result.collect()}
    assert found == {**dict.fromkeys(range(61), 0), 100: 100, **dict.fromkeys(range(200, 240), 100)}


def brute_spans(pairs):
    data = [(doc_id, (text or "").encode()) for doc_id, text in pairs]
    seen = Counter(each[at : at + 200] for _, each in data for at in range(len(each) - 199))
    rows = []
    for doc_id, each in data:
        gone = bytearray(len(each))
        for at in range(len(each) - 199):
            if seen[each[at : at + 200]] > 1:
                gone[at : at + 200] = b"\1" * 200
        kept = bytes(byte for byte, out in zip(each, gone) if not out)
        spans = len(re.findall(b"\1+", bytes(gone)))
        rows.append((doc_id, len(each), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(rows, key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_spans_equal_brute_force(docs, seed, monkeypatch):
    monkeypatch.setattr(repeated_spans, "LEAST_RANGES", 3)
    rng = random.Random(seed)
    passage, long = prose(rng, 45), prose(rng, 300)
    pairs = [(number, prose(rng, rng.randrange(0, 200))) for number in range(20)]
    pairs += [(50 + number, f"{prose(rng, 20)} {passage} {prose(rng, 20)}") for number in range(12)]
    pairs += [(70 + number, edited(rng, long, 3)) for number in range(8)]
    pairs += [(80, "ab" * 900), (81, "é" * 150), (82, "é" * 120 + "x"), (83, long + long), (84, None), (85, ""), (86, "x" * 199)]
    pairs += [(90, passage[:199]), (91, passage[:200]), (92, passage[:201]), (93, long), (93, long), (None, long), (None, None)]
    result = repeated_spans.span_digests(docs(pairs))
    assert sorted((tuple(row) for row in result.collect()), key=str) == brute_spans(pairs)


def found_in_batches(batches, order):
    """Runs of repeated strings by document, with the blocks of the batches read in this order."""

    def met(dealt):
        return repeated_spans._met(pa.Table.from_batches([dealt[at] for at in order])).to_pylist()

    def sent(rows):
        columns = [np.concatenate(each) for each in zip(*(row[1:] for row in rows))]
        owner = np.repeat(np.arange(len(rows)), [len(row[1]) for row in rows])
        return repeated_spans._dealt(*columns[:2], owner, *columns[2:], np.array([row[0] for row in rows]), 1)

    data = {document: np.frombuffer(text.encode(), np.uint8) for batch in batches for document, text in batch}
    rows = met([sent([(document, *repeated_spans.phrases(data[document])) for document, _ in batch]) for batch in batches])
    starts = {}
    for row in rows:
        if not row["repeated"]:
            first, last = repeated_spans._bounds([row["runs"]])
            starts.setdefault(row["document"], set()).update(at for a, b in zip(first, last) for at in range(a, b + 1))
    dealt = []
    for batch in batches:
        strings = []
        for document, _ in batch:
            at = np.array(sorted(starts.get(document, ())), np.int64)
            hashes = SubstringHashes(data[document]).of(at, at + 200)
            strings.append((document, hashes, np.zeros_like(hashes), at, at))
        dealt.append(sent(strings))
    found = {}
    for row in rows + met(dealt):
        if row["repeated"]:
            found.setdefault(row["document"], []).append(row["runs"])
    return found


@pytest.mark.parametrize("seed", range(6))
def test_spans_do_not_depend_on_which_block_is_read_first(seed):
    """Batches that hold a phrase alone or twice, and batches that hold it beside others with its key."""
    rng = random.Random(seed)
    keys = [set()]
    while not set.intersection(*keys):
        core = prose(rng, 40)[:150]
        variants = [f"{prose(rng, 9)[:40]}{core}{prose(rng, 9)[:40]}" for _ in range(3)]
        keys = [set(repeated_spans.phrases(np.frombuffer(text.encode(), np.uint8))[0].tolist()) for text in variants]
    p, q, r = variants
    for texts in ([[p, q], [p]], [[q, p], [q]], [[p, q], [p, p]], [[p, q], [p, r], [p]], [[p, p, q], [p]], [[p, q], [p], [q]], [[p, q], [r], [p]]):
        numbers = iter(range(100))
        batches = [[(next(numbers), text) for text in batch] for batch in texts]
        pairs = [pair for batch in batches for pair in batch]
        expected = {row[0]: row[2] for row in brute_spans(pairs)}
        for order in permutations(range(len(batches))):
            found = found_in_batches(batches, order)
            assert {document: int(repeated_spans.removed_bytes(len(text), found.get(document)).sum()) for document, text in pairs} == expected


def test_cut_texts_keep_columns_and_whole_characters(docs):
    shared = "ü" * 130  # 260 bytes
    frame = docs([(1, f"a{shared}b"), (2, f"c{shared}"), (3, "clean text"), (4, None), (5, "")])
    cut = repeated_spans.without_repeats(frame)
    assert cut.schema == frame.schema
    texts = {row.doc_id: row.text for row in cut.collect()}
    assert texts == {1: "ab", 2: "c", 3: "clean text", 4: None, 5: ""}


def test_lines_keep_the_earliest_with_offsets(docs):
    line, other = "the very same line", "another line of words"
    pairs = [(1, f"x\n{line}\n{other}"), (2, f"The  very same LINE\nshort\n{line}"), (3, f"{other}\nshort"), (4, None), (5, ""), (6, line), (6, line)]
    kept = without_repeated_lines(docs(pairs))
    assert kept.columns[:2] == ["n_chars" if name is None else name for name in docs(pairs).columns[:2]]
    found = sorted(((row.doc_id, row.n_units, [(each.start, each.unit) for each in row.kept_units]) for row in kept.where("doc_id < 6").collect()), key=str)
    assert found == [
        (1, 3, [(0, "x"), (2, line), (21, other)]),
        (2, 3, [(20, "short")]),
        (3, 2, [(22, "short")]),
        (4, 0, []),
        (5, 0, []),
    ]
    assert [row.t for row in kept.where("doc_id = 6").select(kept_text().alias("t")).collect()] == ["", ""]


def test_query_removes_repeated_lines_of_any_length(spark, docs, tmp_path):
    thai = "สวัสดีชาวโลกนี่คือย่อหน้ายาวที่ไม่มีช่องว่าง"
    pairs = [(1, f"les.\n\n{thai}\ntwo words"), (2, f"Les.\n\n \n{thai}\nTWO  words\nnew"), (3, "les.\nles.\nown"), (4, ""), (5, None)]
    docs(pairs).write.parquet(f"{tmp_path}/documents.parquet")
    found = {row.doc_id: (row.n_units, row.n_removed, row.kept_sha256) for row in QUERIES["op9_line_dedup"](spark, str(tmp_path)).collect()}
    seen, expected = set(), {}
    for doc_id, text in pairs:
        lines = (text or "").split("\n") if text else []
        kept = []
        for line in lines:
            normal = " ".join(line.lower().split())
            if not normal or normal not in seen:
                kept.append(line)
            seen.add(normal)
        expected[doc_id] = (len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest())
    assert found == expected
    assert [expected[at][1] for at in range(1, 6)] == [0, 3, 2, 0, 0]


def test_line_dedup_takes_any_column_names(spark):
    names = "doc_id bigint, text string, removed int, _removed int, _Removed_ int, text_hash int, n_units int"
    frame = spark.createDataFrame([(1, "a b\nc", 5, 6, 7, 8, 9), (2, "c\nd", 5, 6, 7, 8, 9), (3, None, 5, 6, 7, 8, 9)], names)
    rows = without_repeated_lines(frame, least_words=1).orderBy("doc_id").collect()
    assert [[unit.unit for unit in row.kept_units] for row in rows] == [["a b", "c"], ["d"], []]
    assert [(row.removed, row["_removed"], row["_Removed_"], row.text_hash, row.n_units) for row in rows] == [(5, 6, 7, 8, n) for n in (2, 2, 0)]


def test_odd_lines_are_equal_as_in_sql(spark, docs, tmp_path):
    spaces = "\u00a0\u1680\u2000\u2003\u200a\u202f\u205f\u3000"
    first = ["ΟΔΟΣ ΝΕΑ ΟΔΟΣ", "İstanbul", "les.", "no-break", "Straße\u2028", "a\u00a0b", *(f"end{ord(each)}" for each in spaces)]
    later = ["οδοσ νεα οδοσ", "istanbul", " \u00a0les.\r", "\u3000\u00a0 no-break \u00a0", "STRAßE", "A B", *(f"End{ord(each)}{each}" for each in spaces)]
    blank = ["\u00a0", " \u3000\t", *spaces, ""]
    pairs = [(1, "\n".join(first + blank)), (2, "\n".join(later + blank)), (3, "οδος νεα οδος\ni\u0307stanbul\n\u2028\n\u0085"), (4, "Straße\n\u2028\n\u0085")]
    docs(pairs).write.parquet(f"{tmp_path}/documents.parquet")
    found = sorted(map(tuple, QUERIES["op9_line_dedup"](spark, str(tmp_path)).collect()))
    with duckdb.connect() as database:
        database.execute(f"CREATE VIEW documents AS SELECT doc_id, text FROM '{tmp_path}/documents.parquet/*.parquet'")
        assert found == sorted(database.execute(sql()).fetchall())
    assert {row[0]: row[2] for row in found} == {1: 0, 2: 12, 3: 0, 4: 3}
