"""Blocks of rows ask shards: packed requests go by shard, packed answers come back by block.

A block is what a task saw of a table at a time.  It sends a shard one packed request, made
of distinct keys, so a key of very many rows sends one entry per block and not one per row.
A shard is a hash range of keys and holds a packed state.  Requests and answers stream
through the tasks that hold a state or a block, so memory is bounded by one of those.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# rows of a request or an answer are told from the state or body they belong to by their order
FIRST = -1


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of one dimension as bytes."""
    head = json.dumps([[a.dtype.str, len(a)] for a in arrays]).encode()
    body = b"".join([len(head).to_bytes(4, "little"), head, *(a.tobytes() for a in arrays)])
    return zstandard.ZstdCompressor(level=1).compress(body)


def unpack(blob: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    at = 4 + int.from_bytes(raw[:4], "little")
    out = []
    for kind, count in json.loads(raw[4:at]):
        out.append(np.frombuffer(raw, kind, count, at))
        at += out[-1].nbytes
    return out


def shard_bits(spark: SparkSession) -> int:
    """Shards are a few times as many as a shuffle has partitions, so that they even out."""
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return min(20, max(4, (4 * partitions).bit_length()))


def by_shard(shards: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """``(shard, begin, end)`` of the runs of a sorted column of shards."""
    if len(shards):
        cuts = [0, *(np.flatnonzero(np.diff(shards)) + 1).tolist(), len(shards)]
        for begin, end in zip(cuts, cuts[1:]):
            yield int(shards[begin]), begin, end


class BlockNumbers:
    """Numbers of the blocks of one task, different from those of all other tasks."""

    def __init__(self):
        self.next = TaskContext.get().partitionId() << 32

    def take(self) -> int:
        self.next += 1
        return self.next


BLOCK_SCHEMA = "block long, shard int, packed binary"
_ARROW = pa.schema([("block", pa.int64()), ("shard", pa.int32()), ("packed", pa.binary())])


def rows(entries: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    """``(block, shard, packed)`` rows; the body of a block has shard :data:`FIRST`."""
    columns = zip(*entries) if entries else ([], [], [])
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW
    )


def bodies(blocks: DataFrame) -> DataFrame:
    return blocks.where(F.col("shard") == FIRST)


def requests(blocks: DataFrame) -> DataFrame:
    return blocks.where(F.col("shard") != FIRST)


def states(
    blocks: DataFrame, fold: Callable[[list[list[np.ndarray]]], list[np.ndarray]], build, limit: int
) -> DataFrame:
    """One row per shard with its state, in ``(block, shard, packed)`` form.

    ``fold`` joins the arrays of several requests to those of one; it is called whenever a
    shard holds ``limit`` entries more, so memory follows distinct keys.  ``build`` makes the
    arrays of the state from those of the folded request.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, size = None, [], 0

        def state():
            return rows([(FIRST, now, pack(*build(fold(held))))])

        for batch in batches:
            for shard, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                if shard != now and held:
                    yield state()
                    held, size = [], 0
                now = shard
                held.append(unpack(blob.as_py()))
                size += len(held[-1][0])
                if size > limit:
                    held, size = [fold(held)], 0
        if held:
            yield state()

    placed = requests(blocks).select("shard", "packed")
    placed = placed.repartition("shard").sortWithinPartitions("shard")
    return placed.mapInArrow(run, BLOCK_SCHEMA)


def answers(states: DataFrame, blocks: DataFrame, load, reply) -> DataFrame:
    """``(block, shard, packed)``: what a shard says to each request.

    ``load`` turns the arrays of a state into what ``reply`` takes beside the arrays of a
    request; ``reply`` gives the arrays of the answer, or None for no answer.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            out = []
            for block, shard, blob in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)
            ):
                arrays = unpack(blob.as_py())
                if block == FIRST:
                    now, state = shard, load(arrays)
                    continue
                made = reply(state, arrays) if shard == now else None
                if made is not None:
                    out.append((block, shard, pack(*made)))
            if out:
                yield rows(out)

    both = states.select("block", "shard", "packed").union(
        requests(blocks).select("block", "shard", "packed")
    )
    placed = both.repartition("shard").sortWithinPartitions("shard", "block")
    return placed.mapInArrow(run, BLOCK_SCHEMA)


def settled(blocks: DataFrame, answered: DataFrame, finish, schema: str) -> DataFrame:
    """Rows that ``finish(body, {shard: answer})`` makes of each block, as record batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, body, got = None, None, {}
        for batch in batches:
            for block, shard, blob in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)
            ):
                if block != now:
                    if body is not None:
                        yield finish(body, got)
                    now, body, got = block, None, {}
                if shard == FIRST:
                    body = unpack(blob.as_py())
                else:
                    got[shard] = unpack(blob.as_py())
        if body is not None:
            yield finish(body, got)

    both = bodies(blocks).select("block", "shard", "packed").union(answered)
    placed = both.repartition("block").sortWithinPartitions("block", "shard")
    return placed.mapInArrow(run, schema)
