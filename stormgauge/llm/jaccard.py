"""Exact Jaccard self-join of word shingles by token-combination prefixes.

A document's set holds its distinct shingles of ``words`` words (A-Z lower-cased, words
between blanks and 0x09-0x0D; the whole sequence if it has fewer).  Two documents link when
``100 * intersection >= percent * union``.  Equal sets are one node, named by a 64-bit
fingerprint; links are looked for between nodes.

Candidates.  Shingles are ordered rare ones first, then frequent ones, each by hash.  With
``a`` shingles, linked sets share a shingle among their first ``p = a - ceil(t a) + 1``.
If the first shared shingle is rare, indexing single rare shingles of that prefix finds the
pair.  If it is frequent, everything they share is frequent; at most ``D`` shingles of
either set are missing in the other, so among the first ``D + 2`` shared ones two follow
each other in both sets.  Those lie in the first ``2 p + 2`` shingles, so indexing pairs of
consecutive frequent shingles of that longer prefix finds it.  A document with ``p`` rare
shingles needs no pairs.  Which shingles count as frequent may be any function of the
shingle (here: a bitmap of fixed size made from counts over all documents), without a
change in the result.  A pair needs to be seen at its first shared shingle only, so an entry
with ``r`` shingles left in the order is worth a look only if ``r`` can hold the overlap.

Verification.  Every index entry gives stars around its smallest set only.  Parity bitmaps
bound the difference of two sets from below and drop most pairs; the rest are compared
shingle by shingle.  Linked stars give first components.  What is left are pairs in one
index entry but in different components: they meet in blocks within tasks, and a task passes
on a forest over the pairs that the bitmaps allow.  Its trees, over all tasks, are clusters,
and the whole sets of a cluster meet in blocks within tasks, which pass on a forest of links.
So no step makes more rows than nodes in its cells, yet no link between different components
is lost.  The sets of a cluster of ``n`` nodes go to ``n / BLOCK`` tasks each.

``percent`` must lie between 75 and 100: below, two linked sets may miss so many shingles that
pairs of consecutive frequent ones no longer suffice.  Further columns, whatever their names,
are left out of :func:`jaccard_components` and stay in :func:`one_per_component`.

Null, empty and blank texts have no shingles, link with nothing and are their own
component.  Very long texts are used whole; memory grows with the longest text.  Repeated
rows share a node.  A row without id has no id to be the smallest and takes its
component's; rows stay as often as they occur, and an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stormgauge.llm.common import components, discard, small_batches, staged
from stormgauge.llm.words import chunks, mix

# documents from which a shingle counts as frequent, and the size of the bitmap of those
FREQUENT = 8
FREQUENT_BITS = 26
# nodes that are compared with each other in one go, and shingles of such nodes
BLOCK = 1024
BLOCK_SHINGLES = 400_000
# bits of a shingle that are counted, and shingles packed together in a task
COUNTED_BITS = 40
COUNTED = 4_000_000
_ODD = np.random.default_rng(5).integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)


def shingle_sets(column: pa.Array, words: int) -> Iterator[tuple[int, np.ndarray]]:
    """``(row, sorted distinct shingle hashes)`` of each text of a column."""
    for row, count, found in chunks(column):
        h, first = found.hash, found.first.tolist()
        m = len(h) - words + 1
        full = np.zeros(max(m, 0), np.uint64)
        for j in range(words if m > 0 else 0):
            full += h[j : j + m] * _ODD[j]
        full = mix(full)
        for k in range(count):
            begin, end = first[k], first[k + 1]
            if end - begin >= words:
                s = np.sort(full[begin : end - words + 1])
                fresh = np.empty(len(s), bool)
                fresh[0] = True
                np.not_equal(s[1:], s[:-1], out=fresh[1:])
                yield row + k, s[fresh]
            elif end > begin:
                n = end - begin
                whole = (h[begin:end] * _ODD[words : words + n]).sum(dtype=np.uint64)
                yield row + k, mix(np.array([whole + np.uint64(n)]))
            else:
                yield row + k, h[:0]


def fingerprint(s: np.ndarray) -> int:
    """64-bit name of a set, as a signed number."""
    total = mix(s ^ _ODD[40]).sum(dtype=np.uint64)
    return int(mix(np.array([total ^ np.uint64(len(s))])).view(np.int64)[0])


def parity(s: np.ndarray) -> bytes:
    """Bit ``b`` tells whether an odd number of shingles fall on it; about two bits a shingle."""
    bits = 1 << max(6, int(2 * len(s) - 1).bit_length())
    at = np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits(at.astype(np.uint8) & 1, bitorder="little").tobytes()


def least_difference(one: bytes, other: bytes) -> int:
    """A lower bound of the size of the symmetric difference, from two parity bitmaps."""
    if len(one) < len(other):
        one, other = other, one
    n, x = len(one), int.from_bytes(one, "little")
    while n > len(other):
        n //= 2
        x = (x >> (8 * n)) ^ (x & ((1 << (8 * n)) - 1))
    return (x ^ int.from_bytes(other, "little")).bit_count()


def _batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    arrays = [pa.array(c, f.type) for c, f in zip(columns, schema)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def _described(docs: DataFrame, words: int) -> DataFrame:
    """One row per document with its node, and blocks of packed shingles for counting."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("content", pa.int64()), ("fp", pa.int64())]
        + [("size", pa.int32()), ("parity", pa.binary()), ("part", pa.int32()), ("block", pa.binary())]
    )
    # as many parts as a shuffle of these data has partitions, or a few times as many
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part_bits = min(20, max(8, (2 * partitions).bit_length()))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, kept, total = set(), [], 0

        def packed():
            parts, blocks = pack_counts(np.concatenate(kept), part_bits)
            none = pa.nulls(len(parts))
            return _batch(schema, *[none.cast(f.type) for f in list(schema)[:5]], parts, blocks)

        for batch in batches:
            fps, sizes, bits = [], [], []
            for _, s in shingle_sets(batch.column(2), words):
                sizes.append(len(s))
                fps.append(fingerprint(s) if len(s) else None)
                bits.append(parity(s) if len(s) else None)
                if len(s) and fps[-1] not in seen:
                    seen.add(fps[-1])
                    kept.append(s >> np.uint64(64 - COUNTED_BITS))
                    total += len(s)
                    if total > COUNTED:
                        yield packed()
                        kept, total = [], 0
            none = pa.nulls(len(fps))
            columns = [batch.column(0), batch.column(1), fps, sizes, bits]
            yield _batch(schema, *columns, none.cast(pa.int32()), none.cast(pa.binary()))
        if kept:
            yield packed()

    made = docs.mapInArrow(
        describe,
        "doc_id long, content long, fp long, size int, parity binary, part int, block binary",
    )
    return staged(made, "shingles")


def pack_counts(values: np.ndarray, part_bits: int) -> tuple[list[int], list[bytes]]:
    """Sorted values of ``COUNTED_BITS`` bits as compressed steps, a block for each part."""
    values = np.sort(values)
    shift = np.uint64(COUNTED_BITS - part_bits)
    cuts = np.searchsorted(values >> shift, np.arange((1 << part_bits) + 1, dtype=np.uint64))
    compress, parts, blocks = zstandard.ZstdCompressor(level=1).compress, [], []
    for part in np.flatnonzero(np.diff(cuts)).tolist():
        own = values[cuts[part] : cuts[part + 1]] & ((np.uint64(1) << shift) - np.uint64(1))
        steps = np.diff(own, prepend=np.uint64(0)).astype("<u4").view(np.uint8)
        parts.append(part)
        blocks.append(compress(steps.reshape(-1, 4).T.tobytes()))
    return parts, blocks


def unpack_counts(block: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(block), np.uint8)
    steps = np.ascontiguousarray(raw.reshape(4, -1).T).view("<u4").ravel()
    return np.cumsum(steps, dtype=np.uint64)


def _frequent(described: DataFrame, least: int) -> DataFrame:
    """``(token)``: shingles, by their counted bits, that at least ``least`` sets hold.

    A part holds about as much as a shuffle partition, and is counted as a whole.
    """
    partitions = int(described.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part_bits = min(20, max(8, (2 * partitions).bit_length()))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        now = None

        def found():
            value, n = np.unique(np.concatenate(held), return_counts=True)
            value = value[n >= least] | np.uint64(now << (COUNTED_BITS - part_bits))
            token = _signed(value << np.uint64(64 - COUNTED_BITS))
            return pa.RecordBatch.from_arrays([pa.array(token)], ["token"])

        for batch in batches:
            for part, block in zip(*(c.to_pylist() for c in batch.columns)):
                if part != now and held:
                    yield found()
                    held = []
                now = part
                held.append(unpack_counts(block))
        if held:
            yield found()

    blocks = described.where("part is not null").select("part", "block")
    return blocks.repartition("part").sortWithinPartitions("part").mapInArrow(count, "token long")


def _bitmap(values: DataFrame, column: str, bits: int) -> np.ndarray:
    """Bitmap of fixed size of the leading ``bits`` bits of a long column."""
    at = F.shiftrightunsigned(column, 64 - bits)
    cell = F.shiftright(at, 6).alias("cell")
    bit = F.expr(f"shiftleft(1L, cast(shiftrightunsigned({column}, {64 - bits}) & 63 as int))")
    rows = values.select(cell, bit.alias("bit")).groupBy("cell").agg(F.bit_or("bit").alias("bit"))
    out = np.zeros(1 << (bits - 6), np.uint64)
    found = rows.toArrow()
    out[found["cell"].to_numpy()] = found["bit"].to_numpy().view(np.uint64)
    return out


def _in_bitmap(bitmap: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = values >> np.uint64(64 - (len(bitmap).bit_length() - 1) - 6)
    return (bitmap[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def index_keys(s: np.ndarray, frequent: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys under which a set is indexed, and how many shingles are left from each on.

    Keys are single rare shingles and pairs of frequent ones.  A pair of sets that shares a
    rare shingle is found by the first of them, so for pairs of frequent ones all rare
    shingles count as not shared.
    """
    a = len(s)
    p = a - (percent * a + 99) // 100 + 1
    rare, common = s[~frequent], s[frequent]
    left = a - np.arange(min(len(rare), p))
    if len(rare) >= p:
        return rare[:p], left
    common = common[: 2 * p + 2 - len(rare)]
    pairs = mix(common[:-1] * _ODD[50] + common[1:] * _ODD[51])
    return np.concatenate((rare, pairs)), np.append(left, np.full(len(pairs), a - len(rare)))


def _indexed(docs: DataFrame, words: int, percent: int, bitmap: np.ndarray) -> DataFrame:
    """``(token, fp, meta)``; ``meta`` is the size of the set and, in the low half, what is left."""
    schema = pa.schema([("token", pa.int64()), ("fp", pa.int64()), ("meta", pa.int64())])
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, frequent = set(), shared.value
        for batch in batches:
            tokens, fps, metas = [], [], []
            for _, s in shingle_sets(batch.column(0), words):
                fp = fingerprint(s) if len(s) > 1 else None
                if fp is None or fp in seen:
                    continue
                seen.add(fp)
                keys, left = index_keys(s, _in_bitmap(frequent, s), percent)
                tokens.append(keys)
                fps.append(fp)
                metas.append((len(s) << 32) + left)
            if tokens:
                counts = [len(t) for t in tokens]
                yield _batch(
                    schema,
                    _signed(np.concatenate(tokens)),
                    np.repeat(np.array(fps, np.int64), counts),
                    np.concatenate(metas),
                )

    return docs.select("text").mapInArrow(index, "token long, fp long, meta long")


def _postings(indexed: DataFrame, percent: int) -> DataFrame:
    """Index entries with two nodes or more, each row with the centre of its star.

    A task reads its entries sorted by size and holds one row back; the centre is the first
    row, and again the first whose set is too large to link with the centre so far.
    """
    schema = pa.schema(
        [("token", pa.int64()), ("fp", pa.int64()), ("size", pa.int64()), ("left", pa.int64())]
        + [("centre", pa.int64()), ("centre_size", pa.int64())]
    )

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # columns of the last row, and whether its entry has rows before it
        for batch in batches:
            token, fp, meta = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            if not len(token):
                continue
            size, left = meta >> 32, meta & 0xFFFFFFFF
            centre, centre_size = fp.copy(), size.copy()
            joined = False
            if held is not None:
                columns, joined = held
                own = (token, fp, size, left, centre, centre_size)
                token, fp, size, left, centre, centre_size = (
                    np.concatenate((c, x)) for c, x in zip(columns, own)
                )
            same = (token[1:] == token[:-1]) & (fp[1:] == fp[:-1])
            kept = np.concatenate(([True], ~same))
            token, fp, size, left, centre, centre_size = (
                c[kept] for c in (token, fp, size, left, centre, centre_size)
            )
            follows = np.concatenate(([False], token[1:] == token[:-1]))
            own_fp, own_size, start = centre, centre_size, ~follows
            while True:
                at = np.maximum.accumulate(np.where(start, np.arange(len(token)), 0))
                centre, centre_size = own_fp[at], own_size[at]
                far = 100 * centre_size < percent * size
                far[0] = False
                if not far.any():
                    break
                first = far & ~(np.concatenate(([False], far[:-1])) & follows)
                start = start | first
            follows[0] = joined
            more = follows.copy()
            more[:-1] |= follows[1:]
            columns = (token, fp, size, left, centre, centre_size)
            held = tuple(c[-1:] for c in columns), bool(follows[-1])
            more[-1] = False
            if more.any():
                yield _batch(schema, *(c[more] for c in columns))
        if held is not None and held[1]:
            yield _batch(schema, *held[0])

    placed = indexed.repartition("token").sortWithinPartitions("token", "meta", "fp")
    made = placed.mapInArrow(
        post, "token long, fp long, size long, left long, centre long, centre_size long"
    )
    return staged(made, "postings")


def _close(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs ``(a, b)`` whose sizes and parity bitmaps allow a link."""

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p, q, m, n = (c.to_pylist() for c in batch.columns[2:])
            kept = []
            for x, y, a, b in zip(p, q, m, n):
                # the sizes alone differ by as much, too
                least = max(least_difference(x, y), abs(a - b))
                kept.append(100 * (a + b - least) >= percent * (a + b + least))
            yield batch.select([0, 1]).filter(pa.array(kept, pa.bool_()))

    one = nodes.select(
        F.col("fp").alias("a"), F.col("parity").alias("p"), F.col("size").alias("m")
    )
    other = nodes.select(
        F.col("fp").alias("b"), F.col("parity").alias("q"), F.col("size").alias("n")
    )
    joined = pairs.join(one, "a").join(other, "b").select("a", "b", "p", "q", "m", "n")
    return joined.mapInArrow(close, "a long, b long")


def _sets(wanted: DataFrame, docs: DataFrame, words: int) -> DataFrame:
    """``(fp, shingles)`` of the nodes ``(fp, content)``.

    The texts of the nodes in question are picked by a bitmap whose size follows their
    number up to a bound, so that other texts are not moved; a wrong hit is left out when
    the fingerprint is known.
    """
    wanted = staged(wanted, "wanted")
    bits = min(27, max(12, int(16 * wanted.count()).bit_length()))
    shared = docs.sparkSession.sparkContext.broadcast(_bitmap(wanted, "content", bits))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, bitmap = set(), shared.value
        schema = pa.schema([("fp", pa.int64()), ("shingles", pa.binary())])
        for batch in batches:
            content = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            rows = batch.column(1).filter(pa.array(_in_bitmap(bitmap, content)))
            fps, sets = [], []
            for _, s in shingle_sets(rows, words):
                fp = fingerprint(s) if len(s) else None
                if fp is not None and fp not in seen:
                    seen.add(fp)
                    fps.append(fp)
                    sets.append(s.tobytes())
            yield _batch(schema, fps, sets)

    sets = docs.select("content", "text").mapInArrow(pick, "fp long, shingles binary")
    sets = sets.join(wanted.select("fp"), "fp", "left_semi")
    rank = F.row_number().over(Window.partitionBy("fp").orderBy(F.length("shingles")))
    sets = staged(sets.withColumn("_k", rank).where("_k = 1").drop("_k"), "sets")
    discard(wanted)
    return sets


def _verified(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, words: int, percent: int):
    """Links ``(a, b)`` among pairs, by comparing whole sets."""
    ends = pairs.select(F.col("a").alias("fp")).union(pairs.select(F.col("b").alias("fp")))
    wanted = nodes.join(ends.distinct(), "fp", "left_semi").select("fp", "content")
    sets = _sets(wanted, docs, words)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            kept = []
            for s, t in zip(x, y):
                s, t = np.frombuffer(s, np.uint64), np.frombuffer(t, np.uint64)
                common = len(np.intersect1d(s, t, assume_unique=True))
                union = len(s) + len(t) - common
                kept.append(100 * common >= percent * union)
            yield batch.select([0, 1]).filter(pa.array(kept, pa.bool_()))

    one = sets.select(F.col("fp").alias("a"), F.col("shingles").alias("x"))
    other = sets.select(F.col("fp").alias("b"), F.col("shingles").alias("y"))
    joined = pairs.join(other, "b").join(one, "a").select("a", "b", "x", "y")
    links = staged(joined.mapInArrow(compare, "a long, b long"), "links")
    discard(sets)
    return links


def _stars(postings: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    pairs = postings.where("centre <> fp").select(F.col("centre").alias("a"), F.col("fp").alias("b"))
    pairs = pairs.distinct()
    return staged(_close(pairs, nodes, percent), "stars")


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[np.ndarray]]:
    """Columns of each run of rows with equal leading ``keys`` columns, also across batches."""
    held: list[np.ndarray] | None = None
    for batch in batches:
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if held is not None:
            columns = [np.concatenate(pair) for pair in zip(held, columns)]
        if not len(columns[0]):
            continue
        new = np.zeros(len(columns[0]), bool)
        for c in columns[:keys]:
            new[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(new).tolist()]
        for begin, end in zip(cuts, cuts[1:]):
            yield [c[begin:end] for c in columns]
        held = [c[cuts[-1] :] for c in columns]
    if held is not None:
        yield held


def _folded(bitmaps: list[bytes], size: int) -> np.ndarray:
    rows = np.frombuffer(b"".join(bitmaps), np.uint64).reshape(len(bitmaps), -1)
    while rows.shape[1] > size:
        half = rows.shape[1] // 2
        rows = rows[:, half:] ^ rows[:, :half]
    return rows


def least_differences(bitmaps: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """:func:`least_difference` of many pairs, by the lengths of their bitmaps."""
    words = np.array([len(b) // 8 for b in bitmaps])
    out = np.zeros(len(i), np.int64)
    for one in np.unique(words):
        for other in np.unique(words):
            own = np.flatnonzero((words[i] == one) & (words[j] == other))
            if not len(own):
                continue
            size = min(one, other)
            place = np.zeros(len(words), np.int64)
            sides = []
            for length, at in ((one, i), (other, j)):
                members = np.flatnonzero(words == length)
                place[members] = np.arange(len(members))
                rows = _folded([bitmaps[k] for k in members], size)
                sides.append((rows, place[at[own]]))
            for k in range(0, len(own), 20_000):
                (x, p), (y, q) = sides
                apart = x[p[k : k + 20_000]] ^ y[q[k : k + 20_000]]
                out[own[k : k + 20_000]] = np.bitwise_count(apart).sum(axis=1)
    return out


def spanning_forest(met: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a forest that joins what a symmetric matrix of meeting nodes joins."""
    open_, edges = met.any(axis=1), []
    while True:
        start = int(open_.argmax())
        if not open_[start]:
            return edges
        open_[start] = False
        front = np.array([start])
        while len(front):
            seen = met[front] & open_
            fresh = np.flatnonzero(seen.any(axis=0))
            parents = front[seen[:, fresh].argmax(axis=0)]
            edges += zip(parents.tolist(), fresh.tolist())
            open_[fresh] = False
            front = fresh


class Joined:
    """Which nodes a task has joined already; starts over when full, which only repeats edges."""

    def __init__(self, limit: int = 200_000):
        self.parent: dict[int, int] = {}
        self.limit = limit

    def root(self, node: int) -> int:
        path = []
        while node in self.parent:
            path.append(node)
            node = self.parent[node]
        for k in path[:-1]:
            self.parent[k] = node
        return node

    def join(self, a: int, b: int) -> bool:
        if len(self.parent) > self.limit:
            self.parent.clear()
        a, b = self.root(a), self.root(b)
        if a != b:
            self.parent[a] = b
        return a != b


def _candidates(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """A forest over the nodes of index entries that may link.

    Nodes may link if they belong to different components, the shingles left can hold the
    overlap, and the parity bitmaps allow the distance.  Nodes that the task has joined need
    not meet again.  A cell is one block of nodes, or two that meet.
    """
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    joined = Joined()
    for _, _, _, met, side, a, root, size, left, parity_ in _groups(batches, 4):
        if len(a) < 2:
            continue
        now = np.array([joined.root(x) for x in a.tolist()])
        fits = (root[:, None] != root) & (now[:, None] != now)
        fits &= (side[:, None] < side) if met[0] else (a[:, None] < a)
        fits &= (100 + percent) * np.minimum(left[:, None], left) >= percent * (size[:, None] + size)
        i, j = np.nonzero(fits)
        if not len(i):
            continue
        if len(i) < 8:
            least = np.array([least_difference(parity_[x], parity_[y]) for x, y in zip(i, j)])
        else:
            least = least_differences(parity_, i, j)
        least = np.maximum(least, np.abs(size[i] - size[j]))
        total = size[i] + size[j]
        near = 100 * (total - least) >= percent * (total + least)
        meet = np.zeros((len(a), len(a)), bool)
        meet[i[near], j[near]] = meet[j[near], i[near]] = True
        found = [(int(a[x]), int(a[y])) for x, y in spanning_forest(meet)]
        found = [pair for pair in found if joined.join(*pair)]
        if found:
            yield _batch(schema, *zip(*found))


def _cells(own, count):
    """Cells of a node of block ``own``: its own block, and each other one that it meets."""
    every = F.sequence(F.lit(0).cast("long"), count - 1)
    return F.transform(
        every,
        lambda k: F.struct(
            F.least(own, k).alias("low"),
            F.greatest(own, k).alias("high"),
            (own != k).cast("long").alias("met"),
            (own > k).cast("long").alias("side"),
        ),
    )


def _clusters(postings: DataFrame, roots: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """``(node, root)``: nodes that chains of pairs that may link put together.

    Pairs share an index entry and belong to different first components.  Entries of two
    nodes are done by their star, and so are those within one component.  In others the nodes
    of the component that has most of them only meet nodes of the rest, and both meet in
    blocks, so a large group costs rows in proportion to its size.
    """
    entry = postings.select("token", F.col("fp").alias("node"), "size", "left").join(roots, "node", "left")
    entry = staged(entry.select("token", "node", "size", "left", F.coalesce("root", "node").alias("root")), "entries")
    held = entry.groupBy("token", "root").agg(F.count("*").alias("n"))
    mixed = held.groupBy("token").agg(
        F.max(F.struct("n", "root")).alias("most"), F.sum("n").alias("n"), F.count("*").alias("roots")
    )
    blocks = {
        "main": F.col("most.root"),
        "large": F.ceil(F.col("most.n") / BLOCK),
        "small": F.ceil((F.col("n") - F.col("most.n")) / BLOCK),
    }
    mixed = mixed.where("roots > 1 and n > 2").select("token", *(c.alias(k) for k, c in blocks.items()))
    placed = entry.join(mixed, "token")
    placed = placed.join(nodes.select(F.col("fp").alias("node"), "parity"), "node")
    is_main = F.col("root") == F.col("main")
    own = F.pmod(F.xxhash64("node"), F.when(is_main, F.col("large")).otherwise(F.col("small")))
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")

    def cell(low, high, met, side):
        return F.struct(low.alias("low"), high.alias("high"), met.alias("met"), side.alias("side"))

    def every(count):
        return F.sequence(zero, F.col(count) - 1)

    # nodes of the main component meet each block of the others; those meet each other, too
    to_small = F.transform(every("small"), lambda k: cell(own, -1 - k, one, zero))
    to_large = F.transform(every("large"), lambda k: cell(k, -1 - own, one, one))
    cells = F.when(is_main, to_small).otherwise(F.concat(to_large, _cells(own, F.col("small"))))
    keys = ("token", "low", "high", "met")
    placed = placed.select("token", "node", "root", "size", "left", "parity", F.inline(cells))
    placed = placed.select(*keys, "side", "node", "root", "size", "left", "parity")
    placed = placed.repartition(*keys).sortWithinPartitions(*keys)
    near = placed.mapInArrow(lambda batches: _candidates(batches, percent), "a long, b long")
    made = components(near)
    discard(entry)
    return made


def overlaps(sets: list[np.ndarray], columns: int = 2048) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets."""
    owner = np.repeat(np.arange(len(sets), dtype=np.int32), [len(s) for s in sets])
    value = np.concatenate(sets)
    order = np.argsort(value, kind="stable")
    value, owner = value[order], owner[order]
    fresh = np.ones(len(value), bool)
    fresh[1:] = value[1:] != value[:-1]
    shared = ~(fresh & np.append(fresh[1:], True))
    owner, number = owner[shared], np.cumsum((fresh & shared)[shared]) - 1
    out = np.zeros((len(sets), len(sets)), np.float32)
    for first in range(0, int(number[-1]) + 1 if len(number) else 0, columns):
        low, high = np.searchsorted(number, (first, first + columns))
        part = np.zeros((len(sets), columns), np.float32)
        part[owner[low:high], number[low:high] - first] = 1
        out += part @ part.T
    return out.astype(np.int64)


def _compared(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """A forest of links within clusters, decided by whole sets; cells as in :func:`_candidates`."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    joined = Joined()
    for _, _, _, met, side, a, root, blobs in _groups(batches, 4):
        if len(a) < 2:
            continue
        sets = [np.frombuffer(blob, np.uint64) for blob in blobs]
        size = np.array([len(s) for s in sets])
        fits = root[:, None] != root
        if met[0]:
            fits &= side[:, None] != side
        common = overlaps(sets)
        linked = fits & (100 * common >= percent * (size[:, None] + size - common))
        found = [(int(a[x]), int(a[y])) for x, y in spanning_forest(linked)]
        found = [pair for pair in found if joined.join(*pair)]
        if found:
            yield _batch(schema, *zip(*found))


def _between(postings, links, docs, nodes, words: int, percent: int) -> DataFrame:
    """Links between different first components: a forest of each cell that holds some.

    Nodes are first put into clusters by what is known without their sets.  The sets of a
    cluster then meet in blocks of bounded size, where whole sets decide, so a set goes to
    as many tasks as its cluster has blocks, and only a forest leaves a task.
    """
    roots = components(links.select("a", "b"))
    clusters = _clusters(postings, roots, nodes, percent)
    clusters = clusters.select(F.col("node").alias("fp"), F.col("root").alias("cluster"))
    members = clusters.join(nodes.select("fp", "content", "size"), "fp")
    members = members.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    members = staged(members.withColumn("root", F.coalesce("root", "fp")), "members")
    sets = _sets(members.select("fp", "content"), docs, words)
    n_blocks = F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("size") / BLOCK_SHINGLES))
    count = members.groupBy("cluster").agg(n_blocks.alias("blocks"))
    own = F.pmod(F.xxhash64("fp"), F.col("blocks"))
    keys = ("cluster", "low", "high", "met")
    placed = members.join(count, "cluster").select(
        "cluster", "fp", "root", F.inline(_cells(own, F.col("blocks")))
    )
    placed = placed.join(sets, "fp").select(*keys, "side", "fp", "root", "shingles")
    placed = placed.repartition(*keys).sortWithinPartitions(*keys)
    made = staged(placed.mapInArrow(lambda b: _compared(b, percent), "a long, b long"), "between")
    discard(members)
    discard(sets)
    return made


def jaccard_components(
    docs: DataFrame,
    words: int = 5,
    percent: int = 80,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row ``(doc_id, n_shingles, component_id, content, root)`` per document.

    ``component_id`` is the smallest id reachable by links, itself included.  ``content`` is
    the xxhash64 of the text, and ``root`` names the component, null for a text without words.
    """
    if not 75 <= percent <= 100:
        raise ValueError("percent must lie between 75 and 100")
    small_batches(docs.sparkSession)
    docs = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.xxhash64(text).alias("content"),
        F.col(text).alias("text"),
    )
    described = _described(docs, words)
    rows = described.where("size is not null").select("doc_id", "content", "fp", "size", "parity")
    nodes = (
        rows.where("fp is not null")
        .groupBy("fp")
        .agg(
            F.min("doc_id").alias("rep"),
            F.min("content").alias("content"),
            F.min("size").alias("size"),
            F.min("parity").alias("parity"),
        )
    )
    nodes = staged(nodes, "nodes")
    bitmap = _bitmap(_frequent(described, FREQUENT), "token", FREQUENT_BITS)
    postings = _postings(_indexed(docs, words, percent, bitmap), percent)
    stars = _stars(postings, nodes, percent)
    links = _verified(stars, docs, nodes, words, percent)
    links = links.union(_between(postings, links, docs, nodes, words, percent))
    discard(postings)
    roots = components(links.select("a", "b"))
    ids = nodes.select(F.col("fp").alias("node"), "rep").join(roots, "node", "left")
    ids = staged(ids.select("node", "rep", F.coalesce("root", "node").alias("root")), "roots")
    least = ids.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = ids.join(least, "root").select(F.col("node").alias("fp"), "component_id", "root")
    columns = ("doc_id", "size", "component_id", "content", "root")
    filled = rows.where("fp is not null").drop("parity").join(named, "fp").select(*columns)
    empty = rows.where("fp is null").withColumns(
        {"component_id": F.col("doc_id"), "root": F.lit(None).cast("long")}
    )
    both = filled.union(empty.select(*columns))
    return both.withColumn("n_shingles", F.col("size").cast("long")).select(
        "doc_id", "n_shingles", "component_id", "content", "root"
    )


def one_per_component(
    docs: DataFrame,
    words: int = 5,
    percent: int = 80,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The rows of ``docs`` that stay: one of each component, that with the smallest id.

    Rows without words all stay.  Of rows that repeat both id and text one stays, and a
    component without any id keeps one of its rows.
    """
    rows = jaccard_components(docs, words, percent, doc_id, text).where("root is not null")
    kept = rows.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "content")).alias("k")
    )
    kept = kept.select(F.col("k.doc_id").alias("_kept_id"), F.col("k.content").alias("_kept_content"))
    held = docs.select(
        F.struct("*").alias("row"),
        F.col(doc_id).cast("long").alias("_id"),
        F.xxhash64(text).alias("_content"),
        F.coalesce(F.col(text).rlike(r"[^\x20\x09-\x0D]"), F.lit(False)).alias("_words"),
    )
    same = F.col("_id").eqNullSafe(F.col("_kept_id")) & (F.col("_content") == F.col("_kept_content"))
    found = held.where("_words").join(kept, same)
    order = Window.partitionBy("_id", "_content").orderBy(F.lit(0))
    found = found.withColumn("_k", F.row_number().over(order)).where("_k = 1")
    return found.select("row").union(held.where("not _words").select("row")).select("row.*")
