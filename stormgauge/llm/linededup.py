"""Lines that many documents share, dropped in all but one of them.

A line's key is the line without blanks and 0x09-0x0D at both ends, A-Z lower-cased.  Keys
of at least ``least_chars`` code points that at least ``least_docs`` documents hold lose
all their lines, but for those of the largest id that holds it.

Tasks name keys by 64-bit hashes.  The distinct hashes of a shard (a hash range) get a
minimal perfect hash: levels of bits, in which a hash takes the first level where no other
falls on its bit, and its number is the count of bits before.  The number leads to arrays of
fingerprints, of document counts and, for keys that are held often enough, of keepers.
Documents probe these arrays in blocks: a block sends a shard the distinct hashes of its
lines, packed, and the shard answers with those to drop.  No line is joined with another; a
line in a third of all documents makes one entry per block.

A document is a row.  Null and empty texts are one empty line.  Very long texts are used
whole.  Rows without an id count as documents with the smallest id.  Repeated rows count
each; those with the largest id of a key all keep its lines.  Further columns, whatever
their names, stay in ``row``.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stormgauge.llm import routing
from stormgauge.llm.common import small_batches, staged
from stormgauge.llm.words import mix

LEAST_CHARS = 40
LEAST_DOCS = 5
# lines of a block, and entries of a shard after which they are joined
BLOCK_LINES = 200_000
FOLD = 2_000_000
# bits per key of a level of the perfect hash
GAMMA = 2
WHITE = " \t\n\v\f\r"
NO_ID = -(2**63)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_OTHER = np.uint64(0x2545F4914F6CDD1D)


def line_hashes(text: str, least_chars: int) -> tuple[int, list[int], list[int]]:
    """How many lines a text has, and the numbers and hashes of those long enough."""
    lines = text.split("\n")
    at, found = [], []
    for k, line in enumerate(lines):
        if len(line) >= least_chars:
            key = line.strip(WHITE)
            if len(key) >= least_chars:
                at.append(k)
                found.append(xxhash.xxh3_64_intdigest(key.encode().lower()))
    return len(lines), at, found


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys, and a fingerprint for each."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray, prints: np.ndarray):
        self.sizes, self.bits, self.prints = sizes, bits, prints
        counts = np.bitwise_count(bits).astype(np.int64)
        self.before = np.cumsum(counts) - counts

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        sizes, words, left = [], [], keys
        while len(left):
            size = 64 * max(1, -(-GAMMA * len(left) // 64))
            at = cls._places(left, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            words.append(np.packbits(alone, bitorder="little").view(np.uint64))
            sizes.append(size)
            left = left[~alone[at]]
        bits = np.concatenate(words) if words else np.zeros(0, np.uint64)
        made = cls(np.array(sizes, np.int64), bits, np.zeros(len(keys), np.uint32))
        made.prints[made._number(keys)] = cls._print(keys)
        return made

    @staticmethod
    def _places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        seed = np.array([level + 1], np.uint64) * _STEP
        return (mix(keys + seed) % np.uint64(size)).astype(np.int64)

    @staticmethod
    def _print(keys: np.ndarray) -> np.ndarray:
        return (mix(keys ^ _OTHER) >> np.uint64(32)).astype(np.uint32)

    def _number(self, keys: np.ndarray) -> np.ndarray:
        """Number of each key, -1 for keys that no level holds."""
        out = np.full(len(keys), -1, np.int64)
        open_, first = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes.tolist()):
            at = self._places(keys[open_], level, size)
            word, bit = self.bits[first + (at >> 6)], (at & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            number = self.before[first + (at >> 6)] + below
            out[open_[hit]] = number[hit]
            open_, first = open_[~hit], first + size // 64
        return out

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """Number of each key, -1 for keys that are none of those it was made of."""
        number = self._number(keys)
        known = number >= 0
        known[known] = self.prints[number[known]] == self._print(keys[known])
        return np.where(known, number, -1)


def _described(docs: DataFrame, least_chars: int, bits: int) -> DataFrame:
    """Blocks of ``(doc_id, content, text)`` rows: their lines, and requests to shards."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = routing.BlockNumbers()
        docs: list[tuple[int, int, int, int]] = []
        at: list[int] = []
        found: list[int] = []

        def block():
            number = numbers.take()
            doc_ids, contents, n_lines, n_long = np.array(docs, np.int64).T
            h, owner = np.array(found, np.uint64), np.repeat(np.arange(len(docs)), n_long)
            order = np.lexsort((owner, h))
            keys, first, slot = np.unique(h[order], return_index=True, return_inverse=True)
            own = owner[order]
            fresh = np.ones(len(own), bool)
            fresh[1:] = (own[1:] != own[:-1]) | (slot[1:] != slot[:-1])
            count = np.add.reduceat(fresh.astype(np.int64), first)
            most = np.maximum.reduceat(doc_ids[own], first)
            slots = np.empty(len(h), np.uint32)
            slots[order] = slot
            shards = (keys >> np.uint64(64 - bits)).astype(np.int64)
            ranges = list(routing.by_shard(shards))
            body = routing.pack(
                np.ascontiguousarray(doc_ids),
                np.ascontiguousarray(contents),
                n_lines.astype(np.uint32),
                n_long.astype(np.uint32),
                np.array(at, np.uint32),
                slots,
                np.array([r[:2] for r in ranges], np.int64).ravel(),
            )
            out = [(number, routing.FIRST, body)]
            for shard, begin, end in ranges:
                cut = slice(begin, end)
                out.append((number, shard, routing.pack(keys[cut], count[cut], most[cut])))
            return routing.rows(out)

        for batch in batches:
            for doc_id, content, text in zip(*(c.to_pylist() for c in batch.columns)):
                n_lines, own, hashes = line_hashes(text, least_chars)
                if own:
                    docs.append((doc_id, content, n_lines, len(own)))
                    at += own
                    found += hashes
                if len(at) > BLOCK_LINES:
                    yield block()
                    docs, at, found = [], [], []
        if docs:
            yield block()

    return staged(docs.mapInArrow(describe, routing.BLOCK_SCHEMA), "lines")


def _folded(held: list[list[np.ndarray]]) -> list[np.ndarray]:
    keys, count, most = (np.concatenate(c) for c in zip(*held))
    order = np.argsort(keys, kind="stable")
    keys, first = np.unique(keys[order], return_index=True)
    return [keys, np.add.reduceat(count[order], first), np.maximum.reduceat(most[order], first)]


def line_index(blocks: DataFrame, least_docs: int) -> DataFrame:
    """A row per shard: its perfect hash, fingerprints, counts and keepers, packed."""

    def build(folded: list[np.ndarray]) -> list[np.ndarray]:
        keys, count, most = folded
        index = PerfectHash.of(keys)
        number = index(keys)
        counts = np.zeros(len(keys), np.min_scalar_type(int(count.max())))
        keepers = np.zeros(len(keys), np.int64)
        counts[number], keepers[number] = count, most
        return [index.sizes, index.bits, index.prints, counts, keepers[counts >= least_docs]]

    return routing.states(blocks, _folded, build, FOLD)


def probe(state: list[np.ndarray], keys: np.ndarray, least_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Which of the keys are held often enough, and the keepers of those."""
    index, counts, keepers, rank = state
    number = index(keys)
    often = (number >= 0) & (counts[number] >= least_docs) if len(counts) else number >= 0
    return np.flatnonzero(often), keepers[rank[number[often]]]


def load_index(arrays: list[np.ndarray], least_docs: int) -> list:
    sizes, bits, prints, counts, keepers = arrays
    rank = np.cumsum(counts >= least_docs) - 1
    return [PerfectHash(sizes, bits, prints), counts, keepers, rank]


def _to_drop(body: list[np.ndarray], got: dict[int, list[np.ndarray]]) -> pa.RecordBatch:
    """``(id, content, dropped)`` of the documents of a block that lose lines."""
    doc_ids, contents, n_lines, n_long, at, slots, ranges = body
    often = np.zeros(int(slots.max()) + 1, bool)
    keeper = np.zeros(len(often), np.int64)
    for shard, begin in ranges.reshape(-1, 2).tolist():
        if shard in got:
            which, keepers = got[shard]
            often[begin + which.astype(np.int64)] = True
            keeper[begin + which.astype(np.int64)] = keepers
    owner = np.repeat(np.arange(len(doc_ids)), n_long)
    drop = often[slots] & (keeper[slots] != doc_ids[owner])
    losing = np.unique(owner[drop])
    place = np.zeros(len(doc_ids), np.int64)
    length = n_lines[losing].astype(np.int64)
    ends = np.cumsum(np.append(0, length))
    place[losing] = ends[:-1]
    flags = np.zeros(int(ends[-1]), bool)
    flags[place[owner[drop]] + at[drop]] = True
    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flags))
    return pa.RecordBatch.from_arrays(
        [pa.array(doc_ids[losing]), pa.array(contents[losing]), lists],
        ["id", "content", "dropped"],
    )


def drop_shared_lines(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    least_chars: int = LEAST_CHARS,
    least_docs: int = LEAST_DOCS,
) -> DataFrame:
    """One row ``(row, n_lines, n_dropped, kept)`` per document; ``kept`` is its new text."""
    spark = docs.sparkSession
    small_batches(spark)
    own_id = F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID))
    own_text = F.coalesce(F.col(text), F.lit(""))
    slim = docs.select(own_id.alias("id"), F.xxhash64(own_text).alias("content"), own_text.alias("text"))
    # shorter texts have no key
    blocks = _described(slim.where(F.length("text") >= least_chars), least_chars, routing.shard_bits(spark))
    index = staged(line_index(blocks, least_docs), "line-index")

    def reply(state, request):
        which, keepers = probe(state, request[0], least_docs)
        return (which.astype(np.uint32), keepers) if len(which) else None

    answered = routing.answers(index, blocks, lambda a: load_index(a, least_docs), reply)
    found = routing.settled(blocks, answered, _to_drop, "id long, content long, dropped array<boolean>")
    found = staged(found, "lines-to-drop").dropDuplicates(["id", "content"])
    rows = docs.select(
        F.struct("*").alias("row"),
        own_id.alias("id"),
        F.xxhash64(own_text).alias("content"),
    )
    joined = rows.join(found, ["id", "content"], "left")
    whole = F.coalesce(F.col("row")[text], F.lit(""))
    lines = F.split(whole, "\n", -1)
    left = F.filter(lines, lambda line, k: ~F.col("dropped")[k])
    lost = F.size(F.filter("dropped", lambda flag: flag)).cast("long")
    return joined.select(
        "row",
        F.size(lines).cast("long").alias("n_lines"),
        F.when(F.col("dropped").isNull(), F.lit(0).cast("long")).otherwise(lost).alias("n_dropped"),
        F.when(F.col("dropped").isNull(), whole).otherwise(F.array_join(left, "\n")).alias("kept"),
    )
