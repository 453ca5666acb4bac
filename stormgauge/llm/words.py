"""Words of whole Arrow text columns as numpy hashes, without one Python object per word.

A word is a run of bytes other than blank and 0x09-0x0D; A-Z count as a-z.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 19
_RANDOM = np.random.default_rng(20)
_BASE = 0x9E3779B97F4A7C15
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_GRAM = _RANDOM.integers(1, 2**63, (5, 256), dtype=np.uint64) | np.uint64(1)
_powers: list[np.ndarray] = []


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (any fixed one-to-one scrambling will do)."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2^64."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES)
        inverse = pow(_BASE, -1, 2**64)
        _powers[:] = [
            np.concatenate(([np.uint64(1)], np.cumprod(np.full(size - 1, b, np.uint64))))
            for b in (_BASE, inverse)
        ]
    return _powers


@dataclass
class Words:
    """Words of some texts: lowered bytes, spans in them, hashes, and words per text."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    per_text: np.ndarray

    @property
    def first(self) -> np.ndarray:
        return np.concatenate(([0], np.cumsum(self.per_text)))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text column and the offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def words_of(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Words of texts that lie one after the other in ``data``."""
    n = len(data)
    data = _LOWER[data]
    inner = ~_SPACE[data]
    begin, stop = inner.copy(), inner.copy()
    begin[1:] &= ~inner[:-1]
    stop[:-1] &= ~inner[1:]
    cuts = offsets[:-1][offsets[:-1] < n]
    begin[cuts] = inner[cuts]
    cuts = offsets[1:][offsets[1:] > 0] - 1
    stop[cuts] = inner[cuts]
    start, end = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    power, inverse = _power_tables(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * power[:n], out=sums[1:])
    h = mix((sums[end] - sums[start]) * inverse[start])
    per_text = np.diff(np.searchsorted(start, offsets))
    return Words(data, start, end, h, per_text)


def chunks(column: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, Words]]:
    """``(first row, row count, words)`` for runs of rows of about ``size`` bytes."""
    data, offsets = text_buffers(column)
    row, rows = 0, len(offsets) - 1
    while row < rows:
        last = int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1
        last = min(max(last, row + 1), rows)
        part = offsets[row : last + 1]
        yield row, last - row, words_of(data[part[0] : part[-1]], part - part[0])
        row = last


def grams(words: Words, which: np.ndarray, sizes: tuple[int, ...], bits: int):
    """Hashed byte n-grams of the chosen words, each between two end marks.

    Returns ``(buckets, valid, first)``: for each n-gram size a row of buckets per position
    of the marked words, whether an n-gram begins there, and where each word begins.
    """
    start, end = words.start[which], words.end[which]
    length = end - start + 2
    first = np.concatenate(([0], np.cumsum(length)))
    total = int(first[-1])
    text = np.full(total, 0x20, np.uint8)
    source = np.repeat(start - first[:-1] - 1, length) + np.arange(total)
    body = np.ones(total, bool)
    body[first[:-1]] = False
    body[first[1:] - 1] = False
    text[body] = words.data[source[body]]
    room = np.repeat(first[1:], length) - np.arange(total)
    buckets = np.zeros((len(sizes), total), np.int64)
    valid = np.zeros((len(sizes), total), bool)
    shift = np.uint64(64 - bits)
    for k, n in enumerate(sizes):
        h = np.full(total, n * 0x1F123BB5, np.uint64)
        for j in range(n):
            h[: total - j] += _GRAM[j][text[j:]]
        buckets[k] = (mix(h) >> shift).astype(np.int64)
        valid[k] = room >= n
    return buckets, valid, first
