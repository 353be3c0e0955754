"""Bytes covered by a string of 200 that also starts somewhere else.

Prefix-free parsing, with every step a Spark job over packed blocks:

* Triggers.  A rolling hash is taken of the 16 bytes from every position.  The
  trigger of a 200-byte string is the place of the smallest hash among its
  first 101 positions (the leftmost of equal ones).  It depends on the string's
  bytes alone, so equal strings have it at the same place, and no string is
  without one, as could happen with triggers at a fixed residue.
* Phrases.  Neighbouring strings with the same trigger form a phrase; phrases
  overlap, and a document is the sequence of its phrases.  A phrase is known by
  its key (hash of the 100 bytes from the trigger, which all its strings hold)
  and by its hash (of all its bytes and where the trigger lies).
* Dictionary.  Phrases meet by key.  A key met once: its strings are unique.
  A phrase met twice: all its strings are repeated, without a look at any.
* Order.  Only phrases that share their key with different ones are left, at
  the ends of repeated stretches.  Their strings are the suffixes that dictionary
  and parse order would place next to each other, compared over 200 bytes.
  Such an order has ties exactly where strings repeat, so hash classes stand for
  its ranks: strings meet by hash, and those that meet another are repeated.

A batch of documents settles what it can by itself and sends one phrase per key
(one string per hash), so that a range gets at most one from each batch,
however common a passage is.  Texts move once to the phrases left over and once
to the result; phrases and strings move as hashes of 64 bits.

Null and empty texts, and texts shorter than 200 bytes, have nothing to remove.
Rows are told apart by a hash of id and text: rows equal in both repeat each
other.  An empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.blocks import SubstringHashes, pack, range_cuts, run_starts, spread, unpack
from tidemark.llm.common import ZIPPED, lean, lean_group, stored, zipped

LENGTH = 200
#: Bytes hashed for a trigger, and positions a string's trigger is sought at.
TRIGGER = 16
REACH = 101
#: Bytes from the trigger that lie in every string of its phrase.
KEYED = LENGTH - REACH + 1
#: Bytes of text behind one hash range of packed blocks.
TEXT_PER_RANGE = 48 << 20
#: Ranges of a small input, for the sake of parallel work.
LEAST_RANGES = 16

_KEY = "_document_key"
#: Per range: a block of what is sent, its documents, and a block of what the batch has settled itself.
_DEALT = "range int, rows int, block binary, documents binary, owners int, settled binary, sure int"
#: Starts of repeated strings, or of strings to be looked at, as packed runs.
_FOUND = "document bigint, repeated boolean, runs binary"
_RUN = np.dtype([("first", "<u4"), ("last", "<u4")])
#: What a batch knows of something it sends: met once, met with its like only, met with others.
_ONE, _SAME, _DIFFERENT = 0, 1, 2


def _smallest_ahead(values: np.ndarray, reach: int) -> np.ndarray:
    """The smallest of each ``reach`` neighbouring values."""
    width = len(values)
    full = -(-width // reach) * reach
    padded = np.full(full, np.iinfo(values.dtype).max, values.dtype)
    padded[:width] = values
    rows = padded.reshape(-1, reach)
    ahead = np.minimum.accumulate(rows, axis=1).reshape(-1)
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[: width - reach + 1], ahead[reach - 1 : width])


def phrases(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, hash, first, last) of a text's phrases: the starts of its first and last string."""
    if len(data) < LENGTH:
        return (np.empty(0, np.uint64),) * 2 + (np.empty(0, np.int64),) * 2
    hashes = SubstringHashes(data)
    starts = len(data) - LENGTH + 1
    at = np.arange(starts + REACH - 1, dtype=np.uint64)
    ranked = (hashes.of_width(TRIGGER)[: len(at)] & np.uint64(0xFFFFFFFF00000000)) | at
    trigger = (_smallest_ahead(ranked, REACH) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = run_starts(trigger)
    last = np.append(first[1:] - 1, starts - 1)
    trigger = trigger[first]
    key = hashes.of(trigger, trigger + KEYED)
    shape = (trigger - first) * (REACH + 1) + (last - first)
    return key, spread(hashes.of(first, last + LENGTH) + shape.astype(np.uint64)), first, last


def _runs(owner: np.ndarray, repeated: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, ...]:
    """The same, sorted, with neighbouring starts of an owner joined."""
    order = np.lexsort((first, repeated, owner))
    owner, repeated, first, last = owner[order], repeated[order], first[order], last[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (repeated[1:] != repeated[:-1]) | (first[1:] != last[:-1] + 1)
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(owner)) - 1
    return owner[starts], repeated[starts], first[starts], last[ends[: len(starts)]]


def _classes(hashes: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of rows sorted by both: the size of each row's hash group, whether it has
    different others, how many rows equal this one, and whether this is their first."""
    starts = run_starts(hashes)
    sizes = np.diff(np.append(starts, len(hashes)))
    different = others[starts] != others[starts + sizes - 1] if len(starts) else np.empty(0, bool)
    equal = np.ones(len(hashes), bool)
    equal[1:] = (hashes[1:] != hashes[:-1]) | (others[1:] != others[:-1])
    own = np.flatnonzero(equal)
    alike = np.repeat(np.diff(np.append(own, len(hashes))), np.diff(np.append(own, len(hashes))))
    return np.repeat(sizes, sizes), np.repeat(different, sizes), alike, equal


def _dealt(
    hashes: np.ndarray, others: np.ndarray, owner: np.ndarray, first: np.ndarray, last: np.ndarray, documents: np.ndarray, ranges: int
) -> pa.RecordBatch:
    """One row per range: what the batch sends there, and what it knows already.

    ``others`` tells different things with one hash apart.  One row is sent for
    each hash.  Of equal things met twice all are repeated; where there are
    different ones, too, one of the equal ones is still to be looked at, for the
    others' sake.
    """
    order = np.lexsort((others, hashes))
    hashes, others, owner, first, last = hashes[order], others[order], owner[order], first[order], last[order]
    sizes, different, alike, lead = _classes(hashes, others)
    state = np.where(sizes == 1, _ONE, np.where(different, _DIFFERENT, _SAME)).astype(np.uint8)
    sent = run_starts(hashes)
    unsure = different & lead
    doubled = alike > 1
    told = [(owner[rows], np.full(rows.sum(), verdict), first[rows], last[rows]) for rows, verdict in ((unsure, False), (doubled, True))]
    settled = _runs(*(np.concatenate(each) for each in zip(*told)))
    goes = settled[0] % ranges
    cuts = range_cuts(hashes[sent], ranges, 64)
    rows = []
    for number in range(ranges):
        part = sent[cuts[number] : cuts[number + 1]]
        known = goes == number
        if not len(part) and not known.any():
            continue
        used = np.unique(owner[part])
        own = [each[known] for each in settled]
        rows.append(
            (
                number,
                len(part),
                pack(
                    hashes[part],
                    others[part] >> np.uint64(16),
                    np.searchsorted(used, owner[part]).astype(np.uint32),
                    first[part].astype(np.uint32),
                    (last[part] - first[part]).astype(np.uint8),
                    state[part],
                ),
                documents[used].tobytes(),
                len(used),
                pack(documents[own[0]], own[1].astype(np.uint8), own[2].astype(np.uint32), own[3].astype(np.uint32)),
                len(own[0]),
            )
        )
    names = ["range", "rows", "block", "documents", "owners", "settled", "sure"]
    kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int32(), pa.binary(), pa.int32()]
    columns = zip(*rows) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(each, kind) for each, kind in zip(columns, kinds)], names=names)


def _met(blocks: pa.Table) -> pa.Table:
    """What a range finds: repeated phrases, and those to be looked at string by string."""
    parts, settled = [], []
    for rows, block, documents, known, sure in zip(*(blocks[name].to_pylist() for name in ("rows", "block", "documents", "settled", "sure"))):
        if rows:
            columns = unpack(block, rows, np.uint64, np.uint64, np.uint32, np.uint32, np.uint8, np.uint8)
            columns[2] = np.frombuffer(documents, np.int64)[columns[2]]
            columns[4] = columns[3] + columns[4]
            parts.append(columns)
        if sure:
            settled.append(unpack(known, sure, np.int64, np.uint8, np.uint32, np.uint32))
    found = settled
    if parts:
        hashes, others, document, first, last, state = (np.concatenate(each) for each in zip(*parts))
        # Of equal rows, one that its batch does not mark as unsure itself leads, whichever block was read first.
        order = np.lexsort((state, others, hashes))
        hashes, others, document, first, last, state = (each[order] for each in (hashes, others, document, first, last, state))
        sizes, different, alike, lead = _classes(hashes, others)
        starts = run_starts(hashes)
        different |= np.repeat(np.maximum.reduceat(state, starts) == _DIFFERENT, np.diff(np.append(starts, len(hashes))))
        # A row that stands for equal ones of its batch has been told as repeated there.  A batch that
        # met different things looks at its own row of each; the lead shows these what others hold.
        unsure = different & lead & (state != _DIFFERENT)
        doubled = (alike > 1) & (state == _ONE)
        for rows, verdict in ((unsure, 0), (doubled, 1)):
            found.append([document[rows], np.full(rows.sum(), verdict, np.uint8), first[rows], last[rows]])
    document, repeated, first, last = _runs(*(np.concatenate(each) for each in zip(*found))) if found else (np.empty(0, np.int64),) * 4
    new = np.ones(len(document), bool)
    new[1:] = (document[1:] != document[:-1]) | (repeated[1:] != repeated[:-1])
    cuts = np.flatnonzero(new)
    packed = np.empty(len(document), _RUN)
    packed["first"], packed["last"] = first, last
    return pa.table(
        {
            "document": pa.array(document[cuts], pa.int64()),
            "repeated": pa.array(repeated[cuts].astype(bool), pa.bool_()),
            "runs": pa.array([packed[a:b].tobytes() for a, b in zip(cuts, np.append(cuts[1:], len(document)))], pa.binary()),
        }
    )


def _ranges(docs: DataFrame, text: str) -> int:
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return max(LEAST_RANGES, -(-total // TEXT_PER_RANGE))


def _data(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode(), np.uint8)


def met_phrases(texts: DataFrame, ranges: int) -> DataFrame:
    """(document, repeated, runs) of phrases whose key is met twice."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            documents = batch.column(0).to_numpy(zero_copy_only=False)
            found = [phrases(_data(text)) for text in batch.column(1).to_pylist()]
            if found:
                key, own, first, last = (np.concatenate(each) for each in zip(*found))
                owner = np.repeat(np.arange(len(found)), [len(each[0]) for each in found])
                yield _dealt(key, own, owner, first, last, documents, ranges)

    return texts.mapInArrow(lean(parse), _DEALT).groupBy("range").applyInArrow(lean_group(_met), _FOUND)


def met_strings(packed: DataFrame, ranges: int) -> DataFrame:
    """(document, repeated, runs) of repeated strings among those whose starts are in ``runs``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            documents = batch.column(0).to_numpy(zero_copy_only=False)
            hashes, starts = [], []
            for packed, size, runs in zip(*(batch.column(at).to_pylist() for at in (1, 2, 3))):
                first, last = _bounds(runs)
                sizes = last - first + 1
                at = np.unique(np.repeat(first - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum()))
                starts.append(at)
                hashes.append(SubstringHashes(_unzipped(packed, size)).of(at, at + LENGTH))
            if starts:
                at = np.concatenate(starts)
                owner = np.repeat(np.arange(len(starts)), [len(each) for each in starts])
                every = np.concatenate(hashes)
                yield _dealt(every, np.zeros_like(every), owner, at, at, documents, ranges)

    return packed.mapInArrow(lean(cut), _DEALT).groupBy("range").applyInArrow(lean_group(_met), _FOUND)


def _bounds(runs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    every = np.frombuffer(b"".join(runs), _RUN)
    return every["first"].astype(np.int64), every["last"].astype(np.int64)


def _unzipped(packed: bytes | None, size: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(packed, size, codec="zstd", asbytes=True), np.uint8) if size else np.empty(0, np.uint8)


def _listed(found: DataFrame) -> DataFrame:
    return found.groupBy("document").agg(F.collect_list("runs").alias("runs"))


def with_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the text compressed (see ``zipped``), plus ``_runs``: lists of
    packed runs, the starts of repeated strings (null for none)."""
    keyed = docs.withColumn(_KEY, F.xxhash64(key, text))
    texts = keyed.select(F.col(_KEY).alias("document"), F.col(text).alias("text"))
    ranges = _ranges(docs, text)
    met = stored(met_phrases(texts, ranges))
    unsure = _listed(met.where("NOT repeated"))
    strings = met_strings(zipped(texts, "text").join(unsure, "document").select("document", ZIPPED, f"{ZIPPED}_size", "runs"), ranges)
    found = stored(met.where("repeated").unionByName(strings.where("repeated")))
    runs = _listed(found).select(F.col("document").alias(_KEY), F.col("runs").alias("_runs"))
    return zipped(keyed, text).join(runs, _KEY, "left").drop(_KEY)


def removed_bytes(size: int, runs: list[bytes] | None) -> np.ndarray:
    """Which of a text's bytes lie in repeated strings."""
    edges = np.zeros(size + 1, np.int32)
    if runs:
        first, last = _bounds(runs)
        np.add.at(edges, first, 1)
        np.add.at(edges, last + LENGTH, -1)
    return np.cumsum(edges[:-1]) > 0


def span_digests(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, spans, kept = [], [], [], []
            for packed, size, runs in zip(*(batch.column(at).to_pylist() for at in (1, 2, 3))):
                data = _unzipped(packed, size)
                gone = removed_bytes(size, runs)
                sizes.append(size)
                removed.append(int(gone.sum()))
                spans.append(int((gone[1:] & ~gone[:-1]).sum() + gone[:1].sum()))
                kept.append(hashlib.sha256(data[~gone].tobytes()).hexdigest())
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    repeats = with_repeats(docs.select(key, text), key, text).select(key, ZIPPED, f"{ZIPPED}_size", "_runs")
    kind = docs.schema[key].dataType.simpleString()
    return repeats.mapInArrow(lean(run), f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with repeated bytes cut out of the text.  A character goes when all
    its bytes are repeated.  Null texts stay null."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for packed, size, runs in zip(*(batch.column(name).to_pylist() for name in (ZIPPED, f"{ZIPPED}_size", "_runs"))):
                data = _unzipped(packed, size)
                if runs:
                    character = np.cumsum((data & 0xC0) != 0x80) - 1
                    kept = np.zeros(character[-1] + 1, bool)
                    kept[character[~removed_bytes(size, runs)]] = True
                    data = data[kept[character]]
                texts.append(None if packed is None else data.tobytes().decode())
            columns = [pa.array(texts, pa.string()) if name == text else batch.column(name) for name in names]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return with_repeats(docs, key, text).mapInArrow(lean(run), T.StructType(docs.schema.fields[:]))
