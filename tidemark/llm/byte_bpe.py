"""Byte-level BPE encoding and decoding over Arrow batches.

The tokenizers library works on characters, so each byte is shown to it as one
printable character; decoding reverses that table.  A rank file lists only
tokens.  Byte pair encoding by ranks joins *any* two neighbours whose
concatenation is a token, so every way of splitting a token into two tokens is
given to the library as a merge, in the order of the ranks.

Texts are cut by the pattern first.  Pieces repeat a lot, so a worker keeps the
ids of pieces it has seen and passes only new ones to the library.  Offsets are
byte offsets into the UTF-8 text plus the first character touched: a token may
hold part of a character, and then its neighbours name the same character.

Nulls and empty texts give no ids; repeated rows are encoded each; other
columns, whatever their names, pass through unread.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer, models, pre_tokenizers

from tidemark.llm.common import lean

#: Pieces a worker remembers before it starts anew; a matter of memory only.
REMEMBERED_PIECES = 250_000


def byte_characters() -> list[str]:
    """A printable character for each byte: itself where it prints, else one from 256 on."""
    prints = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    spare = itertools.count(256)
    return [chr(byte) if byte in prints else chr(next(spare)) for byte in range(256)]


class ByteBpe:
    """Encoder and decoder for one rank file; made once per worker."""

    _made: dict[tuple[str, str], ByteBpe] = {}

    @classmethod
    def of(cls, rank_file: str, pattern: str) -> ByteBpe:
        key = (rank_file, pattern)
        if key not in cls._made:
            cls._made[key] = cls(rank_file, pattern)
        return cls._made[key]

    def __init__(self, rank_file: str, pattern: str):
        with open(rank_file, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.bytes_of: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.length_of = np.array([len(token) for token in self.bytes_of], dtype=np.int64)
        characters = byte_characters()
        shown = {token: "".join(characters[byte] for byte in token) for token in ranks}
        merges = [
            (shown[token[:cut]], shown[token[cut:]])
            for token in sorted(ranks, key=ranks.__getitem__)
            for cut in range(1, len(token))
            if token[:cut] in shown and token[cut:] in shown
        ]
        vocabulary = {shown[token]: rank for token, rank in ranks.items()}
        self.library = Tokenizer(models.BPE(vocab=vocabulary, merges=merges, ignore_merges=True))
        self.library.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.pieces = regex.compile(pattern).findall
        self.known: dict[str, bytes] = {}

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        encoded = []
        for text in texts:
            pieces = self.pieces(text) if text else []
            known = self.known
            new = [piece for piece in set(pieces) if piece not in known]
            if new:
                if len(known) > REMEMBERED_PIECES:
                    known = self.known = {}
                    new = list(set(pieces))
                for piece, result in zip(new, self.library.encode_batch_fast(new, add_special_tokens=False)):
                    known[piece] = np.array(result.ids, dtype="<u4").tobytes()
            encoded.append(b"".join(map(known.__getitem__, pieces)))
        return encoded

    def decode(self, ids: bytes) -> bytes:
        """The bytes of the ids, which need not be whole characters one by one."""
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))

    def offsets(self, text: str, ids: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Where each token starts: its byte, and the character that byte is part of."""
        lengths = self.length_of[np.frombuffer(ids, dtype="<u4")]
        starts = np.cumsum(lengths) - lengths
        raw = np.frombuffer(text.encode(), dtype=np.uint8)
        character = np.cumsum((raw & 0xC0) != 0x80) - 1
        return starts, character[starts]


def _mapped(df: DataFrame, columns: list[str], schema: str, rank_file: str, pattern: str, rows) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = ByteBpe.of(rank_file, pattern)
        for batch in batches:
            yield rows(tool, batch)

    return df.select(*columns).mapInArrow(lean(run), schema)


def encode(docs: DataFrame, rank_file: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids, byte_starts, char_starts) of every row's whole text."""

    def rows(tool: ByteBpe, batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(1).to_pylist()
        ids = tool.encode(texts)
        starts = [tool.offsets(text or "", each) for text, each in zip(texts, ids)]
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array([np.frombuffer(each, dtype="<u4").astype(np.int32) for each in ids], pa.list_(pa.int32())),
                pa.array([each[0] for each in starts], pa.list_(pa.int64())),
                pa.array([each[1] for each in starts], pa.list_(pa.int64())),
            ],
            names=[key, "ids", "byte_starts", "char_starts"],
        )

    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, ids array<int>, byte_starts array<bigint>, char_starts array<bigint>"
    return _mapped(docs, [key, text], schema, rank_file, pattern, rows)


def decode(encoded: DataFrame, rank_file: str, pattern: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(key, bytes) for rows of ids; null ids give no bytes."""

    def rows(tool: ByteBpe, batch: pa.RecordBatch) -> pa.RecordBatch:
        packed = [np.array(each or [], dtype="<u4").tobytes() for each in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([tool.decode(each) for each in packed], pa.binary())], names=[key, "bytes"]
        )

    kind = encoded.schema[key].dataType.simpleString()
    return _mapped(encoded, [key, ids], f"`{key}` {kind}, bytes binary", rank_file, pattern, rows)


def round_trip(
    docs: DataFrame, rank_file: str, pattern: str, key: str = "doc_id", text: str = "text", with_ids: bool = False
) -> DataFrame:
    """Per row: key, n_tokens, ids_sha256 (of the ids as little-endian unsigned
    32-bit integers) and decoded_sha256 (of the bytes decoded from those ids),
    and the ids themselves if wanted.

    Encodes and decodes in one pass, so ids need not travel through Spark.
    """

    def rows(tool: ByteBpe, batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = tool.encode(batch.column(1).to_pylist())
        columns = [
            batch.column(0),
            pa.array([len(each) // 4 for each in ids], pa.int64()),
            pa.array([hashlib.sha256(each).hexdigest() for each in ids], pa.string()),
            pa.array([hashlib.sha256(tool.decode(each)).hexdigest() for each in ids], pa.string()),
        ]
        names = [key, "n_tokens", "ids_sha256", "decoded_sha256"]
        if with_ids:
            columns.append(pa.array([np.frombuffer(each, "<u4").astype(np.int32) for each in ids], pa.list_(pa.int32())))
            names.append("ids")
        return pa.RecordBatch.from_arrays(columns, names=names)

    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return _mapped(docs, [key, text], schema + (", ids array<int>" if with_ids else ""), rank_file, pattern, rows)
