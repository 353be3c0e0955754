"""Hashes of substrings, and packed blocks of sorted hashes dealt by hash range.

A hash per word or per byte is too much to move as one Spark row each.  A batch
of documents therefore sorts its hashes, cuts them at the bounds of hash ranges
and sends one compressed block per range; Spark shuffles the blocks, and what
has one hash meets in one range.  Callers choose the number of ranges in
proportion to the input, so that a range stays the same size at any scale.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_SYMBOLS = np.random.default_rng(20).integers(0, 1 << 64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_SPREAD = np.uint64(0xD6E8FEB86659FD93)
_HALF = np.uint64(32)
_powers: dict[str, np.ndarray] = {}


def _power_tables(length: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse (modulo 2**64), at least ``length`` of them."""
    if not _powers or len(_powers["up"]) < length:
        size = 1 << max(16, int(length - 1).bit_length())
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, np.uint64(base))
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def spread(hashes: np.ndarray) -> np.ndarray:
    """Mix all bits, in place."""
    hashes ^= hashes >> _HALF
    hashes *= _SPREAD
    hashes ^= hashes >> _HALF
    return hashes


class SubstringHashes:
    """64-bit rolling hashes of any substrings of ``data`` from one pass over it."""

    def __init__(self, data: np.ndarray):
        up, self.down = _power_tables(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_SYMBOLS[data] * up[: len(data)], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return spread((self.sums[ends] - self.sums[starts]) * self.down[starts])

    def of_width(self, width: int) -> np.ndarray:
        """Of the substrings of this width from every start."""
        return spread((self.sums[width:] - self.sums[:-width]) * self.down[: len(self.sums) - width])


def pack(*columns: np.ndarray) -> bytes:
    """Columns of equal length, the first one sorted, as one compressed block."""
    if not len(columns[0]):
        return b""
    first = np.diff(columns[0], prepend=columns[0].dtype.type(0))
    planes = [np.ascontiguousarray(each).view(np.uint8).reshape(len(each), -1).T.tobytes() for each in (first, *columns[1:])]
    return pa.compress(b"".join(planes), codec="zstd", asbytes=True)


def unpack(block: bytes, rows: int, *kinds: type) -> list[np.ndarray]:
    if not rows:
        return [np.empty(0, kind) for kind in kinds]
    widths = [np.dtype(kind).itemsize for kind in kinds]
    raw = np.frombuffer(pa.decompress(block, rows * sum(widths), codec="zstd", asbytes=True), np.uint8)
    columns, at = [], 0
    for kind, width in zip(kinds, widths):
        columns.append(np.ascontiguousarray(raw[at : at + rows * width].reshape(width, rows).T).view(kind).reshape(rows))
        at += rows * width
    columns[0] = np.cumsum(columns[0], dtype=kinds[0])
    return columns


def range_cuts(hashes: np.ndarray, ranges: int, bits: int) -> list[int]:
    """Where the bounds of the ranges cut sorted ``hashes`` of so many bits."""
    bounds = (np.arange(1, ranges, dtype=object) * (1 << bits)) // ranges
    return [0, *np.searchsorted(hashes, bounds.astype(np.uint64)).tolist(), len(hashes)]


def range_blocks(hashes: np.ndarray, ranges: int, bits: int, *others: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
    """(range, rows, block) of sorted hashes and what goes with them."""
    cuts = range_cuts(hashes, ranges, bits)
    for number, (low, high) in enumerate(zip(cuts, cuts[1:])):
        if high > low:
            yield number, high - low, pack(hashes[low:high], *(each[low:high] for each in others))


def run_starts(values: np.ndarray) -> np.ndarray:
    """Where runs of equal values start in sorted ``values``."""
    return np.flatnonzero(np.concatenate((np.ones(min(1, len(values)), bool), values[1:] != values[:-1])))
