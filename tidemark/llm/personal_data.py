"""Personal data in texts: patterns propose, checksums confirm, context weighs.

Each kind has a pattern that proposes spans, a check that refuses what cannot be
one (Luhn for cards, mod 97 for bank accounts and French numbers, check letters
and digits of other national numbers, ranges for addresses and dates), and a
score: the kind's prior, plus ``CHECKED`` where a checksum held, plus ``NEAR``
where one of the kind's context words stands within ``REACH`` characters of the
span.  A span counts from ``LEAST_SCORE`` on.

* The base kinds (email, ip, card, phone) have priors that reach the limit
  alone: what their pattern finds and their check confirms always stays.
* The added kinds reach it by checksum (bank accounts), by their form (IPv6) or
  with a context word only (numbers that chance could produce).

Spans of a kind are leftmost and do not overlap; spans of different kinds may.
Starts and ends are code points, ends exclusive.  A pattern walks over a text
once: local parts are taken back from each ``@``, and numbers start only where
the run of digits does, so that long unbroken texts cost no more than others.

Null and empty texts have no spans; repeated rows are searched each; an empty
table gives an empty result.  Other columns pass through, whatever their names;
one named like the result column is replaced.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
import string
from collections.abc import Callable, Iterator
from datetime import date
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import lean

LEAST_SCORE = 0.6
CHECKED, NEAR = 0.35, 0.3
#: Characters on either side of a span that are searched for context words.
REACH = 40

SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"
_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])

_LOCAL = string.ascii_letters + string.digits + "._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=\x20?[A-Z0-9])")
_IPV6 = re.compile(r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:.])")
_SSN = re.compile(r"(?<![0-9-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")
_NIR = re.compile(r"(?<![0-9A-Za-z])[12](?:\x20?[0-9]){4}\x20?[0-9][0-9AB](?:\x20?[0-9]){8}(?![0-9A-Za-z])")
_DNI = re.compile(r"(?<![0-9A-Za-z])([0-9]{8}|[XYZ][0-9]{7})-?([A-Z])(?![0-9A-Za-z])")
_TAX_ID = re.compile(r"(?<![0-9A-Za-z])[1-9][0-9](?:\x20?[0-9]{3}){3}(?![0-9A-Za-z])")
_DATE = re.compile(r"(?<![0-9./-])(?:([0-9]{4})-([0-9]{1,2})-([0-9]{1,2})|([0-9]{1,2})[./-]([0-9]{1,2})[./-]([0-9]{4}))(?![0-9./-]*[0-9])")

# Characters of a bank account number by country.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AT": 20, "BE": 16, "BG": 22, "BR": 29, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20,
    "ES": 24, "FI": 18, "FR": 27, "GB": 22, "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IS": 26, "IT": 27, "LI": 21,
    "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MT": 31, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24, "RS": 22, "SA": 24,
    "SE": 24, "SI": 19, "SK": 24, "SM": 27, "TR": 26, "UA": 29,
}

# The check letters of Spanish numbers, by the number mod 23.
DNI_LETTERS = "TRWAGMYFPDXBNJZSQVHLCKE"


class Kind(NamedTuple):
    name: str
    propose: Callable[[str], Iterator[tuple[int, int, bool]]]  # (start, end, whether a checksum held)
    prior: float
    context: re.Pattern | None


def luhn(digits: str) -> bool:
    """Whether the sum of the digits, every second one from the right doubled
    (9 less where that has two), is a multiple of 10."""
    doubled = sum(sum(divmod(2 * int(each), 10)) for each in digits[-2::-2])
    return (doubled + sum(map(int, digits[-1::-2]))) % 10 == 0


def mod_97(account: str) -> bool:
    """Whether a bank account number, its first four characters moved to the end
    and its letters read as 10 to 35, is 1 mod 97."""
    return int("".join(str(int(each, 36)) for each in account[4:] + account[:4])) % 97 == 1


def mod_11_10(digits: str) -> bool:
    """Whether the last digit is the ISO 7064 check digit of the others."""
    rest = 10
    for each in digits[:-1]:
        rest = 2 * ((int(each) + rest) % 10 or 10) % 11
    return (11 - rest) % 10 == int(digits[-1])


def emails(text: str) -> Iterator[tuple[int, int, bool]]:
    done = 0  # where the last address, or the last @, ended
    at = text.find("@")
    while at >= 0:
        before = text[done:at]
        start = done + len(before.rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end(), False
        done = domain.end() if domain else at + 1
        at = text.find("@", done)


def addresses(text: str) -> Iterator[tuple[int, int, bool]]:
    for found in _IP.finditer(text):
        if all(len(part.lstrip("0")) < 4 and int(part) <= 255 for part in found[0].split(".")):
            yield found.start(), found.end(), False


def cards(text: str) -> Iterator[tuple[int, int, bool]]:
    for found in _DIGITS.finditer(text):
        if found.end() - found.start() >= 14:
            digits = found[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                yield found.start(), found.end(), True


def phones(text: str) -> Iterator[tuple[int, int, bool]]:
    for found in _PHONE.finditer(text):
        if 10 <= sum(map(str.isdecimal, found[0])) <= 15:
            yield found.start(), found.end(), False


def accounts(text: str) -> Iterator[tuple[int, int, bool]]:
    done = 0
    for found in _IBAN.finditer(text):
        length = IBAN_LENGTHS.get(found[0][:2])
        if not length or found.start() < done:
            continue
        # The rest of the number, a space allowed before each of its characters.
        end, seen = found.end(), [found[0]]
        while sum(map(len, seen)) < length:
            place = end + (text[end : end + 1] == " ")
            if text[place : place + 1] not in string.digits + string.ascii_uppercase or not text[place : place + 1]:
                break
            seen.append(text[place])
            end = place + 1
        number = "".join(seen)
        if len(number) == length and not text[end : end + 1].isalnum() and mod_97(number):
            done = end
            yield found.start(), end, True


def long_addresses(text: str) -> Iterator[tuple[int, int, bool]]:
    for found in _IPV6.finditer(text):
        try:
            ipaddress.IPv6Address(found[0])
        except ValueError:
            continue
        if sum(map(bool, found[0].split(":"))) >= 3:
            yield found.start(), found.end(), False


def social_security(text: str) -> Iterator[tuple[int, int, bool]]:
    for found in _SSN.finditer(text):
        area, group, serial = found.groups()
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield found.start(), found.end(), False


def french_numbers(text: str) -> Iterator[tuple[int, int, bool]]:
    for found in _NIR.finditer(text):
        number = found[0].replace(" ", "")
        # Corsica's departments 2A and 2B count as 19 and 18.
        plain = number[:13].replace("2A", "19").replace("2B", "18")
        if plain.isdecimal() and int(number[13:]) == 97 - int(plain) % 97:
            yield found.start(), found.end(), True


def spanish_numbers(text: str) -> Iterator[tuple[int, int, bool]]:
    for found in _DNI.finditer(text):
        number = found[1].translate(str.maketrans("XYZ", "012"))
        if DNI_LETTERS[int(number) % 23] == found[2]:
            yield found.start(), found.end(), True


def german_numbers(text: str) -> Iterator[tuple[int, int, bool]]:
    for found in _TAX_ID.finditer(text):
        if mod_11_10(found[0].replace(" ", "")):
            yield found.start(), found.end(), True


def dates(text: str) -> Iterator[tuple[int, int, bool]]:
    for found in _DATE.finditer(text):
        year, month, day = (int(each) for each in (found.groups()[:3] if found[1] else found.groups()[:2:-1]))
        if any(1900 <= year <= 2100 and _is_date(year, *order) for order in ((month, day), (day, month))):
            yield found.start(), found.end(), False


def _is_date(year: int, month: int, day: int) -> bool:
    try:
        return bool(date(year, month, day))
    except ValueError:
        return False


def _words(*words: str) -> re.Pattern:
    return re.compile(rf"(?<!\w)(?:{'|'.join(map(re.escape, words))})(?!\w)", re.IGNORECASE)


#: In the order in which spans with one start are listed.
KINDS = [
    Kind("email", emails, 0.7, _words("email", "e-mail", "mail", "contact", "correo", "courriel")),
    Kind("ip", addresses, 0.6, _words("ip", "host", "server", "address", "client")),
    Kind("card", cards, 0.6, _words("card", "visa", "mastercard", "credit", "karte", "carte", "tarjeta")),
    Kind("phone", phones, 0.6, _words("phone", "tel", "call", "mobile", "fax", "telefon", "téléphone", "teléfono")),
    Kind("iban", accounts, 0.5, _words("iban", "account", "bank", "konto", "compte", "cuenta")),
    Kind("ipv6", long_addresses, 0.6, _words("ip", "ipv6", "host", "server", "address", "client")),
    Kind("us_ssn", social_security, 0.4, _words("ssn", "social security")),
    Kind("fr_nir", french_numbers, 0.2, _words("nir", "sécurité sociale", "numéro de sécu", "insee")),
    Kind("es_dni", spanish_numbers, 0.1, _words("dni", "nif", "nie", "documento nacional")),
    Kind("de_tax_id", german_numbers, 0.1, _words("steuer-id", "steuerid", "idnr", "steuernummer", "identifikationsnummer")),
    Kind("birth_date", dates, 0.4, _words("born", "dob", "birth", "birthday", "geboren", "geburtsdatum", "né", "née", "naissance", "nacido", "nacida", "nacimiento")),
]
BASE_KINDS = ("email", "ip", "card", "phone")
_ORDER = {kind.name: number for number, kind in enumerate(KINDS)}
_DIGIT = re.compile("[0-9]")


def find_spans(text: str | None) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) of a text's spans, by start, then kind."""
    if not text or not ("@" in text or _DIGIT.search(text)):
        return []
    found = []
    for kind in KINDS:
        for start, end, checked in kind.propose(text):
            score = kind.prior + CHECKED * checked
            if kind.context and (kind.context.search(text, max(0, start - REACH), start) or kind.context.search(text, end, end + REACH)):
                score += NEAR
            if score >= LEAST_SCORE - 1e-9:
                found.append((kind.name, start, end, round(min(1.0, score), 2)))
    return sorted(found, key=lambda span: (span[1], _ORDER[span[0]]))


def with_spans(docs: DataFrame, text: str = "text", column: str = "spans") -> DataFrame:
    """``docs`` plus ``column``: the spans of each text."""
    names = [name for name in docs.columns if name != column]
    fields = [field for field in docs.schema.fields if field.name != column]
    source = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                [{"kind": kind, "start": start, "end": end, "score": score} for kind, start, end, score in find_spans(each)]
                for each in batch.column(source).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(name)) for name in names), pa.array(found, pa.list_(_SPAN))],
                names=[*names, column],
            )

    schema = T.StructType([*fields, T.StructField(column, T._parse_datatype_string(SPANS))])
    return docs.mapInArrow(lean(run), schema)


def masked(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with each span's characters replaced by its kind in brackets; of
    overlapping spans the first, then the longest, decides."""
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [_masked(each) for each in batch.column(at).to_pylist()]
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return docs.mapInArrow(lean(run), docs.schema)


def _masked(text: str | None) -> str | None:
    pieces, done = [], 0
    for kind, start, end, _ in sorted(find_spans(text), key=lambda span: (span[1], -span[2])):
        if start >= done:
            pieces += [text[done:start], f"[{kind.upper()}]"]
            done = end
    return "".join([*pieces, text[done:]]) if pieces else text


def span_digests(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, the number of spans of each base kind, base_sha256 (of the
    base spans as kind:start:end, joined by commas) and all spans in that form."""
    found = with_spans(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))).select("doc_id", "spans")
    listed = F.transform("spans", lambda span: F.concat_ws(":", span["kind"], span["start"], span["end"]))
    base = F.transform(
        F.filter("spans", lambda span: span["kind"].isin(*BASE_KINDS)),
        lambda span: F.concat_ws(":", span["kind"], span["start"], span["end"]),
    )

    def number(kind: str):
        return F.size(F.filter("spans", lambda span: span["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[number(kind) for kind in BASE_KINDS],
        F.sha2(F.array_join(base, ","), 256).alias("base_sha256"),
        F.array_join(listed, ",").alias("spans"),
    )


def digest_of(spans: list[tuple[str, int, int]]) -> str:
    """The same digest of a list of spans."""
    return hashlib.sha256(",".join(f"{kind}:{start}:{end}" for kind, start, end in spans).encode()).hexdigest()
