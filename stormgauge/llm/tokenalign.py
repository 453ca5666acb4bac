"""Alignment of two tokenizers over a corpus, each distinct text once.

Texts are shuffled whole and grouped; each distinct text is encoded by a byte-level BPE (A,
with a blank before the text) and by pieces (B) and aligned by byte offsets.  The places
where tokens of either kind end cut a text into stretches, and each stretch is one
overlapping pair of an A and a B token, a link.  Offsets where both end close a group.

An id pair counts in the documents that hold it linked, so a text's pairs weigh as much as
the text has copies.  Blocks of texts send shards (hash ranges of A ids) their distinct
pairs with weights; a shard adds them up, finds the highest count of each A id and answers.
What a text has of its own goes back to all documents with that text: the texts with more
than a thousandth of all copies are at most a thousand and are broadcast, so no other
key of that join holds many rows.

Texts that are null or empty, or whose tokens do not give back the text, have no tokens:
zeros, and an empty ``groups``.  Very long texts are encoded whole; memory grows with the
longest text.  Rows without an id, and repeated rows, are documents like others.  Of ties for
the highest count each is a best one.  Further columns, whatever their names, stay in
``row``.  An empty table gives no rows.
"""

from __future__ import annotations

import functools
import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stormgauge.llm import routing
from stormgauge.llm.common import small_batches, staged
from stormgauge.llm.words import mix

# fixed values: how the byte-level vocabulary splits a text before merging
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
# bytes of text aligned in one go, links of a block, entries of a shard before they are joined
CHUNK_BYTES = 1 << 20
BLOCK_LINKS = 2_000_000
FOLD = 2_000_000
# texts with more than this part of all copies are broadcast
HOT = 1000


def byte_characters() -> dict[str, int]:
    """The bytes that the characters of a byte-level vocabulary stand for."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def byte_level(path: str) -> tuple[tiktoken.Encoding, list[bytes]]:
    """Encoder for the vocabulary of a tokenizers file, without special tokens, and its tokens."""
    with open(path, encoding="utf-8") as file:
        held = json.load(file)
    special = {t["content"] for t in held["added_tokens"]}
    to_byte = byte_characters()
    ranks = {
        bytes(map(to_byte.__getitem__, token)): n
        for token, n in held["model"]["vocab"].items()
        if token not in special
    }
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, n in ranks.items():
        tokens[n] = token
    return tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), tokens


def pieces(path: str) -> tuple[sentencepiece.SentencePieceProcessor, list[bytes]]:
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    tokens = []
    for n in range(model.get_piece_size()):
        piece = model.id_to_piece(n)
        if model.is_byte(n):
            tokens.append(bytes([int(piece[3:-1], 16)]))
        else:
            tokens.append(piece.replace("▁", " ").encode())
    return model, tokens


@dataclass
class Aligned:
    """Texts that have tokens: counts per text, digests of groups, links as ``a * width + b``."""

    which: list[int]
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    digests: list[bytes]
    pairs: np.ndarray


class Aligner:
    def __init__(self, path_a: str, path_b: str):
        self.a, self.tokens_a = byte_level(path_a)
        self.b, self.tokens_b = pieces(path_b)
        self.width = len(self.tokens_b)
        self.length_a = np.array([len(t) for t in self.tokens_a])
        self.length_b = np.array([len(t) for t in self.tokens_b])
        # decimal ids with what may follow them in the text of groups
        numbers = [str(n).encode() for n in range(max(len(self.tokens_a), self.width))]
        shown = [n + mark for mark in (b",", b"|", b";") for n in numbers]
        self.step = len(numbers)
        self.shown = np.empty(len(shown), object)
        self.shown[:] = shown

    def align(self, texts: list[str]) -> Aligned:
        which, of_a, of_b = [], [], []
        found_b = self.b.encode(texts, num_threads=1) if texts else []
        for k, (text, b) in enumerate(zip(texts, found_b)):
            a = self.a.encode_ordinary(" " + text) if text else []
            whole = b" " + text.encode()
            if (
                text
                and b"".join(map(self.tokens_a.__getitem__, a)) == whole
                and b"".join(map(self.tokens_b.__getitem__, b)) == whole
            ):
                which.append(k)
                of_a.append(a)
                of_b.append(b)
        return self._aligned(which, of_a, of_b)

    def _aligned(self, which, of_a, of_b) -> Aligned:
        n_a = np.array([len(a) for a in of_a], np.int64)
        n_b = np.array([len(b) for b in of_b], np.int64)
        if not which:
            none = np.zeros(0, np.int64)
            return Aligned([], n_a, n_b, none, none, [], none)
        a = np.fromiter((i for ids in of_a for i in ids), np.int64, int(n_a.sum()))
        b = np.fromiter((i for ids in of_b for i in ids), np.int64, int(n_b.sum()))
        # texts lie one after the other; both kinds of tokens end where a text ends
        end_a, end_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        ends_a, ends_b = np.zeros(end_a[-1] + 1, bool), np.zeros(end_a[-1] + 1, bool)
        ends_a[end_a] = True
        ends_b[end_b] = True
        last = end_a[np.cumsum(n_a) - 1]
        stretch = np.flatnonzero(ends_a | ends_b)
        stop_a, stop_b = ends_a[stretch], ends_b[stretch]
        pairs = a[np.cumsum(stop_a) - stop_a] * self.width + b[np.cumsum(stop_b) - stop_b]
        closes = np.flatnonzero(ends_a & ends_b)
        n_links = np.diff(np.searchsorted(stretch, last, "right"), prepend=0)
        n_groups = np.diff(np.searchsorted(closes, last, "right"), prepend=0)
        digests = self._digests(a, b, end_a, end_b, ends_a, ends_b, closes, n_a + n_b)
        return Aligned(which, n_a, n_b, n_groups, n_links, digests, pairs)

    def _digests(self, a, b, end_a, end_b, ends_a, ends_b, closes, n_tokens) -> list[bytes]:
        """sha256 of ``a1,a2|b1;a3|b2,b3`` of each text."""
        group_a, group_b = np.searchsorted(closes, end_a), np.searchsorted(closes, end_b)
        upto_a = np.searchsorted(end_a, closes, "right")
        upto_b = np.append(0, np.searchsorted(end_b, closes, "right"))
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + upto_b[group_a]] = a + self.step * ends_b[end_a]
        order[np.arange(len(b)) + upto_a[group_b]] = b + 2 * self.step * ends_a[end_b]
        shown = self.shown[order].tolist()
        out, at = [], 0
        for n in n_tokens.tolist():
            out.append(hashlib.sha256(b"".join(shown[at : at + n])[:-1]).digest())
            at += n
        return out


@functools.lru_cache(maxsize=2)
def _load(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


def _blocks(distinct: DataFrame, path_a: str, path_b: str, bits: int) -> DataFrame:
    """Blocks of ``(text, copies)`` rows: what their documents are told, and requests."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, numbers = _load(path_a, path_b), routing.BlockNumbers()
        names, digests, plain, pairs, times, n_pairs = [], [], [], [], [], []
        size = 0

        def block():
            counts = np.concatenate(plain)
            own, n_own = np.concatenate(pairs), np.concatenate(n_pairs)
            weight = np.repeat(counts[:, 0], n_own)
            shards = (mix((own // aligner.width).astype(np.uint64)) >> np.uint64(64 - bits)).astype(np.int64)
            order = np.lexsort((own, shards))
            fresh = np.ones(len(own), bool)
            fresh[1:] = own[order][1:] != own[order][:-1]
            first = np.flatnonzero(fresh)
            keys, weights = own[order][first], np.add.reduceat(weight[order], first)
            slots = np.empty(len(own), np.uint32)
            slots[order] = np.cumsum(fresh) - 1
            ranges = list(routing.by_shard(shards[order][first]))
            number = numbers.take()
            body = routing.pack(
                np.frombuffer(b"".join(names), np.uint8),
                np.frombuffer(b"".join(digests), np.uint8),
                np.ascontiguousarray(counts).ravel(),
                n_own.astype(np.uint32),
                slots,
                np.concatenate(times),
                np.array([r[:2] for r in ranges], np.int64).ravel(),
            )
            out = [(number, routing.FIRST, body)]
            for shard, begin, end in ranges:
                out.append((number, shard, routing.pack(keys[begin:end], weights[begin:end])))
            return routing.rows(out)

        for texts, copies in _chunks(batches):
            made = aligner.align(texts)
            if not made.which:
                continue
            owner = np.repeat(np.arange(len(made.which)), made.n_links)
            order = np.lexsort((made.pairs, owner))
            own, owner = made.pairs[order], owner[order]
            fresh = np.ones(len(own), bool)
            fresh[1:] = (own[1:] != own[:-1]) | (owner[1:] != owner[:-1])
            first = np.flatnonzero(fresh)
            pairs.append(own[first])
            times.append(np.diff(np.append(first, len(own))).astype(np.uint32))
            n_pairs.append(np.bincount(owner[first], minlength=len(made.which)))
            names += [hashlib.sha256(texts[k].encode()).digest() for k in made.which]
            digests += made.digests
            kept = np.array([copies[k] for k in made.which], np.int64)
            plain.append(
                np.stack([kept, made.n_a, made.n_b, made.n_groups, made.n_links], axis=1)
            )
            size += len(own)
            if size > BLOCK_LINKS:
                yield block()
                names, digests, plain, pairs, times, n_pairs = [], [], [], [], [], []
                size = 0
        if names:
            yield block()

    return staged(distinct.mapInArrow(describe, routing.BLOCK_SCHEMA), "aligned")


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[str], list[int]]]:
    texts, copies, size = [], [], 0
    for batch in batches:
        for text, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            texts.append(text)
            copies.append(n)
            size += len(text)
            if size > CHUNK_BYTES:
                yield texts, copies
                texts, copies, size = [], [], 0
    if texts:
        yield texts, copies


def _folded(held: list[list[np.ndarray]]) -> list[np.ndarray]:
    keys, weights = (np.concatenate(c) for c in zip(*held))
    order = np.argsort(keys, kind="stable")
    keys, first = np.unique(keys[order], return_index=True)
    return [keys, np.add.reduceat(weights[order], first)]


def pair_counts(blocks: DataFrame, width: int) -> DataFrame:
    """A row per shard: its pairs, their counts, and whether these are their A id's highest."""

    def build(folded: list[np.ndarray]) -> list[np.ndarray]:
        keys, counts = folded
        first = np.unique(keys // width, return_index=True)[1]
        highest = np.repeat(np.maximum.reduceat(counts, first), np.diff(np.append(first, len(keys))))
        return [keys, counts, (counts == highest).astype(np.uint8)]

    return routing.states(blocks, _folded, build, FOLD)


def _reply(state: list[np.ndarray], request: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    at = np.searchsorted(state[0], request[0])
    return state[1][at], state[2][at]


MEASURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def _measured(body: list[np.ndarray], got: dict[int, list[np.ndarray]]) -> pa.RecordBatch:
    names, digests, plain, n_own, slots, times, ranges = body
    counts = np.zeros(int(slots.max()) + 1, np.int64)
    best = np.zeros(len(counts), np.int64)
    for shard, begin in ranges.reshape(-1, 2).tolist():
        own = slice(begin, begin + len(got[shard][0]))
        counts[own], best[own] = got[shard]
    first = np.cumsum(n_own, dtype=np.int64) - n_own
    times = times.astype(np.int64)
    plain = plain.reshape(-1, 5).T
    count_sum = np.add.reduceat(times * counts[slots], first)
    n_best = np.add.reduceat(times * best[slots], first)
    name, digest = ([r.tobytes().hex() for r in c.reshape(-1, 32)] for c in (names, digests))
    columns = [pa.array(name), *(pa.array(np.ascontiguousarray(c)) for c in (*plain, n_best, count_sum))]
    return pa.RecordBatch.from_arrays(
        [*columns, pa.array(digest)], ["name", "copies", *MEASURES, "groups_sha256"]
    )


def measured_texts(docs: DataFrame, path_a: str, path_b: str, text: str = "text") -> DataFrame:
    """A row per distinct text with tokens: its sha256, its copies and its measures."""
    small_batches(docs.sparkSession)
    distinct = docs.where(F.length(text) > 0).groupBy(F.col(text).alias("text")).agg(F.count("*").alias("copies"))
    bits = routing.shard_bits(docs.sparkSession)
    blocks = _blocks(distinct, path_a, path_b, bits)
    width = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    counts = staged(pair_counts(blocks, width), "pair-counts")
    answered = routing.answers(counts, blocks, list, _reply)
    schema = ", ".join(
        ["name string", "copies long", *(f"{m} long" for m in MEASURES), "groups_sha256 string"]
    )
    return staged(routing.settled(blocks, answered, _measured, schema), "measures")


def alignments(docs: DataFrame, path_a: str, path_b: str, text: str = "text") -> DataFrame:
    """One row ``(row, n_a, …, count_sum, groups_sha256)`` per document."""
    measures = measured_texts(docs, path_a, path_b, text)
    total = measures.agg(F.sum("copies")).first()[0] or 0
    found = F.struct(*MEASURES, "groups_sha256")
    # at most HOT texts hold more than a HOT-th of all copies
    hot = measures.where(F.col("copies") * HOT > total).select("name", found.alias("hot"))
    cold = measures.where(F.col("copies") * HOT <= total).select("name", found.alias("cold"))
    rows = docs.select(F.struct("*").alias("row"), F.sha2(F.coalesce(F.col(text), F.lit("")), 256).alias("name"))
    rows = rows.join(F.broadcast(hot), "name", "left")
    # their documents, and those without text, look for nothing in the second join
    spread = F.col("hot").isNotNull() | (F.coalesce(F.length(F.col("row")[text]), F.lit(0)) == 0)
    nothing = F.monotonically_increasing_id().cast("string")
    key = F.when(spread, nothing).otherwise(F.col("name"))
    joined = rows.withColumn("name", key).join(cold, "name", "left")
    made = F.coalesce("hot", "cold")
    return joined.select(
        "row",
        *(F.coalesce(made[m], F.lit(0).cast("long")).alias(m) for m in MEASURES),
        F.coalesce(made["groups_sha256"], F.lit("")).alias("groups_sha256"),
    )
