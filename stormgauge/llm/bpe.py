"""Byte-pair encoding and decoding with a public vocabulary, by a contiguous rank array.

A short word keeps its parts and the ranks of adjacent pairs in two plain arrays: the
least rank is found by scanning, one boundary is deleted and the two ranks beside it are
looked up again.  Long words keep the pairs in a heap instead, with the same result.

Nulls count as empty texts, an empty text has no ids, and texts are never cut.  Repeated
rows and further columns pass through as they are; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import gc
import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stormgauge.llm.common import small_batches

# parts from which a word counts as long
LONG_WORD = 96
# words a task remembers; it starts over when full
REMEMBERED = 300_000
# words merged side by side, and bytes of text looked at together
BLOCK_WORDS = 4096
BLOCK_BYTES = 4 << 20
NONE = 1 << 40
# marks a special token among ordinary ones, which never begin with a blank
SPECIAL = " "
MASK = (1 << 20) - 1
TABLE_BITS = 18
SPREAD = np.uint64(0x9E3779B97F4A7C15)
FREE = np.uint64(2**64 - 1)
_TOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+")
# the same for texts of Latin letters and common punctuation, in plain ranges, which is faster
_PLAIN = re.compile(r"[\x00-\u017f\u2010-\u2027\u2030-\u205e]*")
_LETTER, _NUMBER = "a-zA-Z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f", "0-9²³¹¼½¾"
_PLAIN_TOKEN = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^\x09-\x0d \x85\xa0{_LETTER}{_NUMBER}]+"
)


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, spare = [""] * 256, 256
    for b in range(256):
        out[b] = chr(b) if b in shown else chr(spare)
        spare += b not in shown
    return out


def _key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return ((left << 20) | right).astype(np.uint64)


class RankArrayBpe:
    """Encoder and decoder for a vocabulary file of lower-cased words with word ends.

    Character classes are those of ``regex``, whose Unicode version may know some
    characters as letters that an older library does not.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocabulary, end = model["vocab"], model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token = {i: t for t, i in {**vocabulary, **self.special}.items()}
        self.inner = [vocabulary[c] for c in byte_characters()]
        self.last = [vocabulary[c + end] for c in byte_characters()]
        self.pairs = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            key = vocabulary[left] << 20 | vocabulary[right]
            self.pairs.setdefault(key, rank << 20 | vocabulary[left + right])
        self.inner_ids, self.last_ids = np.array(self.inner), np.array(self.last)
        self.keys = np.full(1 << TABLE_BITS, FREE, np.uint64)
        self.ranks = np.full(1 << TABLE_BITS, NONE, np.int64)
        for pair, value in self.pairs.items():
            slot = (pair * int(SPREAD) % 2**64) >> (64 - TABLE_BITS)
            while self.keys[slot] != FREE:
                slot = (slot + 1) % (1 << TABLE_BITS)
            self.keys[slot], self.ranks[slot] = pair, value
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")

    def merge_long(self, parts: list[int]) -> list[int]:
        """Merge a long word with its pairs in a heap, in n log n."""
        get, n = self.pairs.get, len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(get(parts[i] << 20 | parts[i + 1], NONE), i) for i in range(n - 1)]
        heap = [x for x in heap if x[0] != NONE]
        heapq.heapify(heap)
        while heap:
            value, i = heapq.heappop(heap)
            if value == NONE:
                break
            j = after[i]
            if parts[i] < 0 or j >= n or get(parts[i] << 20 | parts[j], NONE) != value:
                continue
            parts[i], parts[j] = value & MASK, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                heapq.heappush(heap, (get(parts[i] << 20 | parts[after[i]], NONE), i))
            if before[i] >= 0:
                k = before[i]
                heapq.heappush(heap, (get(parts[k] << 20 | parts[i], NONE), k))
        return [p for p in parts if p >= 0]

    def lookup(self, key: np.ndarray) -> np.ndarray:
        """Ranks of many pairs at once from an open-addressing table."""
        slot = (key * SPREAD) >> np.uint64(64 - TABLE_BITS)
        held = self.keys[slot]
        while True:
            wrong = np.flatnonzero((held != key) & (held != FREE))
            if not len(wrong):
                break
            slot[wrong] = (slot[wrong] + np.uint64(1)) & np.uint64((1 << TABLE_BITS) - 1)
            held[wrong] = self.keys[slot[wrong]]
        return np.where(held == key, self.ranks[slot], NONE)

    def merge_block(self, tokens: list[bytes]) -> list[list[int]]:
        """Merge short words of similar length side by side, a row of parts and ranks each.

        Every round scans the ranks of each word for its least, deletes that boundary and
        refreshes the two ranks beside it; words without a pair left are done.
        """
        size = np.fromiter(map(len, tokens), np.int64, len(tokens))
        width = int(size.max())
        body = np.frombuffer(b"".join(tokens), np.uint8)
        column = np.arange(width)
        there = column < size[:, None]
        parts = np.full((len(tokens), width + 1), -1, np.int64)
        parts[:, :width][there] = self.inner_ids[body]
        row = np.arange(len(tokens))
        parts[row, size - 1] = self.last_ids[body[np.cumsum(size) - 1]]
        ranks = np.full((len(tokens), width), NONE, np.int64)
        pair = column + 1 < size[:, None]
        ranks[pair] = self.lookup(_key(parts[:, :-1][pair], parts[:, 1:][pair]))
        out: list = [None] * len(tokens)
        while len(row):
            at = ranks.argmin(axis=1)
            least = ranks[np.arange(len(row)), at]
            done = least == NONE
            if done.any():
                for r, n, p in zip(row[done].tolist(), size[done].tolist(), parts[done].tolist()):
                    out[r] = p[:n]
                left = ~done
                row, size, at, least = row[left], size[left], at[left], least[left]
                parts, ranks = parts[left], ranks[left]
                if not len(row):
                    break
            n = np.arange(len(row))
            place = np.arange(ranks.shape[1])
            kept = place + (place > at[:, None])
            parts = np.take_along_axis(parts, np.minimum(kept, parts.shape[1] - 1), 1)
            parts[n, at] = least & MASK
            kept = np.minimum(place + (place >= at[:, None]), ranks.shape[1] - 1)
            ranks = np.take_along_axis(ranks, kept, 1)
            size = size - 1
            most = int(size.max())
            parts = np.concatenate((parts[:, :most], np.full((len(row), 1), -1)), axis=1)
            ranks = ranks[:, :most]
            ranks[n, size - 1] = NONE
            some = np.flatnonzero(at > 0)
            ranks[some, at[some] - 1] = self.lookup(
                _key(parts[some, at[some] - 1], parts[some, at[some]])
            )
            some = np.flatnonzero(at + 1 < size)
            ranks[some, at[some]] = self.lookup(
                _key(parts[some, at[some]], parts[some, at[some] + 1])
            )
        return out

    def tokens(self, text: str) -> list[str]:
        """The runs of characters that are encoded one by one, special tokens whole."""
        out: list[str] = []
        for piece in self.split_special.split(text) if "<|" in text else (text,):
            if piece in self.special:
                out.append(SPECIAL + piece)
                continue
            if not piece.isascii():
                # each capital by itself: a sigma at a word's end has no form of its own
                piece = unicodedata.normalize("NFC", piece).replace("Σ", "σ")
            piece = piece.lower()
            pattern = _PLAIN_TOKEN if _PLAIN.fullmatch(piece) else _TOKEN
            out += pattern.findall(piece)
        return out

    def encode_tokens(self, tokens: list[str]) -> list[list[int]]:
        """Ids of each token."""
        ids: list = [None] * len(tokens)
        raw = [t.encode() for t in tokens]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        order = np.argsort(sizes, kind="stable").tolist()
        short = order[: int((sizes < LONG_WORD).sum())]
        for i in range(0, len(short), BLOCK_WORDS):
            block = short[i : i + BLOCK_WORDS]
            for k, found in zip(block, self.merge_block([raw[k] for k in block])):
                ids[k] = found
        for k in order[len(short) :]:
            parts = [self.inner[b] for b in raw[k]]
            parts[-1] = self.last[raw[k][-1]]
            ids[k] = self.merge_long(parts)
        for k, t in enumerate(tokens):
            if t[0] == SPECIAL:
                ids[k] = [self.special[t[1:]]]
        return ids

    def encode(self, text: str) -> list[int]:
        return [i for ids in self.encode_tokens(self.tokens(text)) for i in ids]

    def decode(self, ids: list[int]) -> str:
        """Tokens joined by blanks, special ones included; the vocabulary has no decoder."""
        return " ".join(self.token[i] for i in ids)


class Remembered:
    """For each known token its ids in one or more forms; starts over when full."""

    def __init__(self, path: str, *forms):
        self.bpe, self.forms = _load(path), forms
        self.known: list[dict] = [{} for _ in forms]

    def blocks(self, column: pa.Array) -> Iterator[list[list[str]]]:
        """Tokens of some texts at a time, all of them known; null counts as empty."""
        block, size = [], 0
        for text in column.to_pylist():
            block.append(self.bpe.tokens(text or ""))
            size += len(text or "")
            if size > BLOCK_BYTES:
                yield self._learn(block)
                block, size = [], 0
        yield self._learn(block)

    def _learn(self, block: list[list[str]]) -> list[list[str]]:
        if len(self.known[0]) > REMEMBERED:
            for known in self.known:
                known.clear()
        new = list(set().union(*block).difference(self.known[0]))
        ids = self.bpe.encode_tokens(new)
        for known, form in zip(self.known, self.forms):
            known.update(zip(new, map(form, ids)))
        return block


@functools.lru_cache(maxsize=2)
def _load(path: str) -> RankArrayBpe:
    # millions of small strings live long here; looking for cycles among them costs a third
    gc.disable()
    return RankArrayBpe(path)


def _id_bytes(ids: list[int]) -> bytes:
    return np.array(ids, np.int32).tobytes()


@functools.lru_cache(maxsize=2)
def _ids_remembered(path: str) -> Remembered:
    """One memory for all tasks of a worker process."""
    return Remembered(path, _id_bytes)


@functools.lru_cache(maxsize=2)
def _digests_remembered(path: str) -> Remembered:
    """Decimal ids and decoded tokens, each with a blank behind, so that a text is a concatenation."""
    bpe = _load(path)
    number = {i: b"%d " % i for i in bpe.token}
    token = {i: t.encode() + b" " for i, t in bpe.token.items()}
    return Remembered(
        path,
        lambda ids: b"".join([number[i] for i in ids]),
        lambda ids: b"".join([token[i] for i in ids]),
    )


def encode_ids(path: str, text: str = "text") -> Column:
    """Column of the ids of a text column, ``array<int>``."""

    @F.arrow_udf("array<int>")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        remembered = _ids_remembered(path)
        known = remembered.known[0].__getitem__
        for batch in batches:
            rows = [
                b"".join(map(known, tokens))
                for block in remembered.blocks(batch)
                for tokens in block
            ]
            ends = np.cumsum([0, *(len(r) // 4 for r in rows)]).astype(np.int32)
            values = pa.Array.from_buffers(
                pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(rows))]
            )
            yield pa.ListArray.from_arrays(pa.array(ends), values)

    return ids(F.col(text))


def decode_ids(path: str, ids: str = "ids") -> Column:
    """Column of the texts of an ids column; null ids give an empty text."""

    @F.arrow_udf("string")
    def texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = _load(path)
        for batch in batches:
            yield pa.array([bpe.decode(row or []) for row in batch.to_pylist()], pa.string())

    return texts(F.col(ids))


def encoded(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """All columns of ``docs`` and the ids of the texts; an ``ids`` column is replaced."""
    small_batches(docs.sparkSession)
    return docs.withColumn(ids, encode_ids(path, text))


def decoded(docs: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    small_batches(docs.sparkSession)
    return docs.withColumn(text, decode_ids(path, ids))


def round_trip(path: str, text: str = "text") -> Column:
    """Struct of token count and digests of ids and decoded text, made in a single pass.

    A word's ids and decoded tokens are kept as the bytes that the digests read, so the ids
    of a document never leave the task.
    """

    @F.arrow_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        remembered = _digests_remembered(path)
        numbers, shown = (known.__getitem__ for known in remembered.known)
        for batch in batches:
            counts, one, two = [], [], []
            for block in remembered.blocks(batch):
                for tokens in block:
                    ids = b"".join(map(numbers, tokens))
                    shown_text = b"".join(map(shown, tokens))
                    counts.append(ids.count(b" "))
                    one.append(hashlib.sha256(ids[:-1]).hexdigest())
                    two.append(hashlib.sha256(shown_text[:-1]).hexdigest())
            yield pa.StructArray.from_arrays(
                [pa.array(counts, pa.int64()), pa.array(one, pa.string()), pa.array(two, pa.string())],
                ["n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return digest(F.col(text))
