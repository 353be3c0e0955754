"""Personal data: the base patterns by brute force, checksums, context, masking."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from tidemark.llm import personal_data
from tidemark.llm.personal_data import find_spans, luhn, mod_11_10, mod_97


def base_spans(text):
    """The base kinds by their plain definitions."""
    found = []
    for match in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append((match.start(), 0, match.end()))
    for match in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(part) <= 255 for part in match[0].split(".")):
            found.append((match.start(), 1, match.end()))
    for match in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(each) for each in match[0] if each.isdigit()]
        total = sum(digits[::-1][at] if at % 2 == 0 else (2 * digits[::-1][at]) // 10 + (2 * digits[::-1][at]) % 10 for at in range(len(digits)))
        if 14 <= len(digits) <= 19 and total % 10 == 0:
            found.append((match.start(), 2, match.end()))
    for match in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= sum(each.isdigit() for each in match[0]) <= 15:
            found.append((match.start(), 3, match.end()))
    kinds = personal_data.BASE_KINDS
    return [(kinds[kind], start, end) for start, kind, end in sorted(found)]


def made_texts():
    rng = random.Random(11)
    pieces = ["a", "b@c.de", "@", ".", "x.y", "%+", "-", "é", " ", "12", "255", "256", "1.2.3.4", "+1 ", "(555) ", "4111 1111 1111 1111", "4111-1111", "7", "0", "mail", "\n", "日"]
    made = ["".join(rng.choice(pieces) for _ in range(rng.randrange(1, 40))) for _ in range(1500)]
    made += ["".join(rng.choice("0123456789. -+@a") for _ in range(60)) for _ in range(1500)]
    return made


def test_base_kinds_by_brute_force():
    seen = Counter()
    for text in made_texts():
        own = [span[:3] for span in find_spans(text) if span[0] in personal_data.BASE_KINDS]
        assert own == base_spans(text), text
        seen.update(kind for kind, _, _ in own)
    assert min(seen[kind] for kind in personal_data.BASE_KINDS) > 20


def test_digests_of_rows(spark, docs):
    texts = [(at, text) for at, text in enumerate(made_texts()[::20])] + [(900, None), (901, ""), (902, "a@b.co"), (902, "a@b.co"), (None, "1.2.3.4")]
    frame = docs(texts)
    rows = personal_data.span_digests(frame).collect()
    expected = Counter()
    for doc_id, text in texts:
        base = base_spans(text or "")
        number = Counter(kind for kind, _, _ in base)
        every = ",".join(f"{kind}:{start}:{end}" for kind, start, end, _ in find_spans(text))
        expected[(doc_id, *(number[kind] for kind in personal_data.BASE_KINDS), personal_data.digest_of(base), every)] += 1
    assert Counter(map(tuple, rows)) == expected
    assert personal_data.span_digests(frame.limit(0)).count() == 0
    named = personal_data.with_spans(frame.withColumnRenamed("kept", "spans").withColumnRenamed("leaks", "kind"))
    assert named.count() == len(texts) and named.columns[-1] == "spans" and named.columns.count("spans") == 1


@pytest.mark.parametrize(
    "text, kind, span",
    [
        ("IBAN DE89 3704 0044 0532 0130 00 OK", "iban", "DE89 3704 0044 0532 0130 00"),
        ("to GB82WEST12345698765432.", "iban", "GB82WEST12345698765432"),
        ("seen at 2001:db8::ff00:42:8329 today", "ipv6", "2001:db8::ff00:42:8329"),
        ("his SSN: 219-09-9999", "us_ssn", "219-09-9999"),
        ("NIR 2 55 08 14 168 025 38", "fr_nir", "2 55 08 14 168 025 38"),
        ("DNI 12345678Z", "es_dni", "12345678Z"),
        ("Steuer-ID 86 095 742 719", "de_tax_id", "86 095 742 719"),
        ("born on 1984-02-29", "birth_date", "1984-02-29"),
        ("geboren 3.12.1970 in", "birth_date", "3.12.1970"),
    ],
)
def test_added_kinds(text, kind, span):
    assert [text[start:end] for name, start, end, _ in find_spans(text) if name == kind] == [span]


@pytest.mark.parametrize(
    "text",
    ["IBAN DE88 3704 0044 0532 0130 00", "219-09-9999", "ssn 000-12-3456", "12345678Z", "dni 12345678A", "86 095 742 719", "1984-02-29", "born 1985-02-29", "std::vector a:b:c", "XX89 3704 0044"],
)
def test_what_no_check_or_context_confirms(text):
    assert not [span for span in find_spans(text) if span[0] not in personal_data.BASE_KINDS]


def test_context_raises_scores():
    plain, near = find_spans("write a@b.co")[0], find_spans("my email: a@b.co")[0]
    assert near[3] > plain[3] >= personal_data.LEAST_SCORE
    far = "ssn" + " x" * 40 + " 219-09-9999"
    assert find_spans(far) == []


def test_checksums():
    assert luhn("79927398713") and not luhn("79927398710")
    assert mod_97("GB82WEST12345698765432") and not mod_97("GB82WEST12345698765431")
    assert mod_11_10("86095742719") and not mod_11_10("86095742718")


def test_very_long_unbroken_texts():
    assert find_spans("a" * 300_000 + "@") == []
    assert find_spans("7" * 300_000) == []
    assert find_spans("a@" * 100_000) == []
    assert find_spans("x" * 200_000 + "@b.co") == [("email", 0, 200_005, 0.7)]


def test_masking(docs):
    rows = personal_data.masked(docs([(1, "a@b.co, 1.2.3.4"), (2, None), (3, ""), (4, "clean")])).collect()
    assert {row.doc_id: row.text for row in rows} == {1: "[EMAIL], [IP]", 2: None, 3: "", 4: "clean"}
    assert rows[0].kept == "x"
