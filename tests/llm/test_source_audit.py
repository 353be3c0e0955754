"""Source divergence by brute force: packed and long terms, tiles, blocks, empty groups."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import source_audit
from tidemark.llm.common import stored

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(each) + 32) if "A" <= each <= "Z" else each for each in text or ""))


def audit(rows, least, top):
    counts, seen = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        own = terms(text)
        counts[lang or "", source or ""].update(own)
        seen[lang or ""].update(set(own))
    result = Counter()
    for lang in {lang for lang, _ in counts}:
        kept = sorted(term for term, n in seen[lang].items() if n >= least)
        groups = {source: counter for (other, source), counter in counts.items() if other == lang}
        whole = Counter()
        for counter in groups.values():
            whole.update(counter)

        def share(counter):
            size = sum(counter[term] for term in kept)
            return {term: 1 + 10**9 * (counter[term] + 5) // (size + 5 * len(kept)) for term in kept}

        shares, q = {source: share(counter) for source, counter in groups.items()}, share(whole)
        for source, p in shares.items():
            pairs = [(-sum(abs(p[term] - other[term]) for term in kept), item.encode()) for item, other in shares.items() if item != source]
            leading = [(q[term] - p[term], term.encode()) for term in kept if groups[source][term] and p[term] > q[term]]
            for part, ranked in (("pair", sorted(pairs)), ("term", sorted(leading)[:top])):
                for rank, (negative, item) in enumerate(ranked, 1):
                    result[lang, source, part, item.decode(), -negative, rank] += 1
    return result


def corpus():
    rng = random.Random(13)
    vocabulary = ["a", "Ab", "é", "日本語", "ﬁ", "x" * 8, "y" * 9, "z" * 16, "q" * 17, "long" * 40, "é" * 8, "é" * 9] + [
        "".join(rng.choice("abé") for _ in range(rng.randrange(1, 40))) for _ in range(60)
    ]
    rows = []
    for at in range(500):
        text = "".join(rng.choice(vocabulary) + rng.choice([" ", "1", ".\n", "\0", "\x7f"]) for _ in range(rng.randrange(30)))
        rows.append((rng.choice(["en", "en", "日", None]), rng.choice(["s1", "s2", "é", "s10", None, ""]), text))
    rows += rows[:3] + [("en", "empty", None), ("en", "blank", " 12 "), ("fr", "lone", "word"), ("de", "one", None), ("de", "two", ""), ("en", "s1", "a" * 100_000 + " b" * 50_000)]
    return rows


@pytest.fixture
def frame(spark):
    named = [(lang, source, text, 1, 2, 3) for lang, source, text in corpus()]
    return spark.createDataFrame(named, "lang string, source string, text string, hi int, n int, value int").repartition(3)


def found(rows):
    return Counter(map(tuple, rows.select("lang", "source", "part", "item", "value", "rank").collect()))


def test_equals_brute_force(frame):
    assert found(source_audit.divergence(frame, least_documents=5, top_terms=7)) == audit(corpus(), 5, 7)


def test_terms_alike_in_their_first_53_bits(spark):
    stems = ["children", "éáóú", "日本"]  # packed, 8 or 6 bytes; with more behind them two words
    alike = [stem[:-1] + last + tail for stem in stems for last in stem[-1] + "sxyz" for tail in ("", "a", "b", "abcdefgh", "abcdefgi")]
    rng = random.Random(5)
    rows = [("en", f"s{at % 3}", " ".join(rng.choices(alike, weights=range(1, len(alike) + 1), k=40))) for at in range(60)]
    found_rows = found(source_audit.divergence(spark.createDataFrame(rows, "lang string, source string, text string"), least_documents=5, top_terms=7))
    assert found_rows == audit(rows, 5, 7)


def test_small_tiles_and_blocks(frame):
    kept = stored(source_audit.kept_terms(source_audit.term_counts(frame), 5))
    groups = stored(source_audit.group_sizes(frame, kept))
    rows = source_audit.pair_differences(kept, groups, tile=2, cells=20)
    expected = {(lang, source, item, value) for lang, source, part, item, value, _ in audit(corpus(), 5, 7) if part == "pair"}
    assert {tuple(row) for row in rows.collect()} == expected
    assert rows.count() == len(expected)


def test_no_kept_terms_and_empty_table(frame):
    rows = source_audit.divergence(frame, least_documents=10_000)
    assert found(rows) == audit(corpus(), 10_000, 50) and {row.value for row in rows.collect()} == {0}
    assert source_audit.divergence(frame.limit(0)).count() == 0


def test_pieces_count_alike(monkeypatch):
    lang, source, text = zip(*[(lang or "", source or "", text or "") for lang, source, text in corpus()])
    batch = pa.RecordBatch.from_arrays([pa.array(each) for each in (lang, source, text)], names=["lang", "source", "text"])

    def total(batch):
        sums = Counter()
        for part in source_audit._count(iter([batch])):
            for lang, source, hi, lo, tail, n, docs in zip(*(column.to_pylist() for column in part.columns)):
                sums[lang, source, hi, lo, tail] += n + 1_000_000 * docs
        return sums

    whole = total(batch)
    assert whole == total(batch.slice(0, 250)) + total(batch.slice(250))
    monkeypatch.setattr(source_audit, "PIECE_BYTES", 100)
    assert total(batch) == whole


def test_radix_order():
    rng = np.random.default_rng(1)
    group, lo, hi = rng.integers(0, 5, 3000).astype(np.uint16), rng.integers(0, 1 << 63, 3000).astype(np.uint64) % 7, rng.integers(0, 1 << 62, 3000).astype(np.uint64)
    order = source_audit.radix_order(group, [(lo, 8), (hi, 8)])
    assert order.tolist() == np.lexsort((group, lo, hi)).tolist()
