"""Language-model scores by Brown class-based bigrams.

Words (A-Z lower-cased, runs of bytes other than blank and 0x09-0x0D, then one end per
text) belong to classes, and

    P(word | word before) = P(class | class before) * P(word | class).

Exchange clustering gives the classes.  It starts from the most frequent words, which are
moved between classes as long as the likelihood of the class bigrams grows, in numpy on the
counts of their bigrams.  Then come exchange passes over all words seen more than once, which
go, in parallel, where the contexts of all their occurrences fit best, the words around them
standing for their classes of the pass before.  The first pass moves all words (one only met
between words without a class goes to a class by hash), each later one a half drawn by hash.  The passes end when few words move, or when the likelihood no longer
grows, of which parallel steps give no guarantee.
Words seen once share a class with words never seen, as one occurrence says little about
either.  Transitions are smoothed with the class frequencies, and the class of rare words
splits its mass as Good and Turing would, so the probabilities over known words, the unknown
word and the end sum to one.

Counts, contexts and transitions cover all training rows.  The vocabulary is a table, never
a broadcast: texts are coded once, in blocks as the tasks read them, as numbers of the
block's distinct words, and a block asks for the classes of those.  Coded texts lie in buckets
by block, so a pass moves words to them and no texts.  Words are named by 64-bit hashes.

Null texts count as empty and consist of the end alone.  Very long texts are scored whole.
Rows without id are scored like others; repeated rows get the same score.  Without training
rows only the unknown word has any mass, and an empty table gives an empty result.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stormgauge.llm.common import discard, small_batches, staged, staged_buckets
from stormgauge.llm.words import chunks

CLASSES = 64
# further classes: words seen once or never, and the end of a text
ONCE, END = CLASSES, CLASSES + 1
ALL = CLASSES + 2
# most frequent words, whose classes the passes over all words start from, and their passes
CORE = 2000
PASSES = 4
# passes over all words end when a smaller share of them moves
FEW = 0.01
# words of a block of texts
BLOCK_WORDS = 4_000_000
# words of blocks in a part of the vocabulary, which a task holds at once
PART_WORDS = 1 << 19
# words of blocks a task packs together
PACKED_ROWS = 1 << 20
# words of blocks whose gains are summed together, few enough for a processor cache
STEP_ROWS = 2000
# a word met so often in a block sends counts by class instead of its contexts
OFTEN = 256
# a word with more contexts in all is summed up from counts by class
SELDOM = 6
# gains are whole multiples of 1 / UNIT, so that their sums do not depend on the order
UNIT = 4096
# weight of the class frequencies in a transition
SMOOTHING = 20.0


_CODED = (
    ("block", pa.int64()),
    ("held_out", pa.bool_()),
    ("ids", pa.binary()),
    ("docs", pa.binary()),
    ("local", pa.int32()),
    ("word", pa.int64()),
    ("n", pa.int64()),
)


_PACKED = (("block", pa.int64()), ("part", pa.int32()), ("words", pa.binary()))


def _batch(schema: tuple, **columns) -> pa.RecordBatch:
    """A record batch of the given columns; those not given are null."""
    rows = len(next(iter(columns.values())))
    made = [
        pa.nulls(rows, t) if (c := columns.get(name)) is None else c if isinstance(c, pa.Array) else pa.array(c, t)
        for name, t in schema
    ]
    return pa.RecordBatch.from_arrays(made, [name for name, _ in schema])


def _packed(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Binary column of runs of ``values``, which end where ``ends`` says."""
    offsets = (np.concatenate(([0], ends)) * values.itemsize).astype(np.int64)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))]
    return pa.Array.from_buffers(pa.large_binary(), len(ends), buffers).cast(pa.binary())


def _unpacked(column: pa.Array, dtype: type) -> tuple[np.ndarray, np.ndarray]:
    """The values of a binary column one after the other, and where each row begins."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if not len(column):
        return np.zeros(0, dtype), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8)[offsets[0] : offsets[-1]] if body else np.zeros(0, np.uint8)
    return data.view(dtype), (offsets - offsets[0]) // np.dtype(dtype).itemsize


def _numbered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values, the most frequent first, and the number of each value among them."""
    found = pa.array(values).dictionary_encode()
    at = found.indices.to_numpy()
    order = np.argsort(-np.bincount(at, minlength=len(found.dictionary)), kind="stable")
    number = np.empty(len(order), np.int32)
    number[order] = np.arange(len(order), dtype=np.int32)
    return found.dictionary.to_numpy()[order], number[at]


def _planes(ids: np.ndarray) -> bytes:
    """Numbers as their lowest bytes, then the next ones: high bytes are alike and compress well."""
    return np.ascontiguousarray(ids.astype(np.int32).view(np.uint8).reshape(-1, 4).T).tobytes()


def _from_planes(raw: pa.BinaryScalar) -> np.ndarray:
    planes = np.frombuffer(raw.as_buffer(), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view(np.int32).ravel()


def _coded(rows: DataFrame) -> DataFrame:
    """Texts as numbers of words within blocks, in buckets by block.

    A row for a block's training texts and one for those held out, with ``ids``, the numbers of
    the words of all these texts and -1 at the end of each, and the ids of the texts, ``docs``; and a
    row per distinct word of a block with its number, hash and count in training texts.
    """

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 24
        held: list[tuple] = []
        size = 0

        def written():
            doc_id, held_out = (pa.concat_arrays([h[k] for h in held]) for k in (0, 1))
            per_text = np.concatenate([h[2] for h in held])
            word, ids = _numbered(np.concatenate([h[3] for h in held]))
            held_out = held_out.to_numpy(zero_copy_only=False)
            of_held = np.repeat(held_out, per_text)
            n = np.bincount(ids[~of_held], minlength=len(word))
            for side in (False, True):
                some = held_out == side
                if not some.any():
                    continue
                own = np.full(int(per_text[some].sum() + some.sum()), -1, np.int32)
                inner = np.ones(len(own), bool)
                inner[np.cumsum(per_text[some] + 1) - 1] = False
                own[inner] = ids[of_held == side]
                docs = _packed_words(pa.table({"doc_id": doc_id.filter(pa.array(some))}))
                yield _batch(_CODED, block=[block], held_out=[side], ids=[_planes(own)], docs=[docs])
            numbers = np.arange(len(word), dtype=np.int32)
            yield _batch(_CODED, block=np.full(len(word), block), local=numbers, word=word.view(np.int64), n=n)

        for batch in batches:
            for row, count, words in chunks(batch.column(2)):
                part = batch.slice(row, count)
                held.append((part.column(0), part.column(1), words.per_text, words.hash))
                size += len(words.hash)
                if size > BLOCK_WORDS:
                    yield from written()
                    block, held, size = block + 1, [], 0
        if held:
            yield from written()

    rows = rows.select("doc_id", "held_out", "text")
    made = rows.mapInArrow(
        code, "block long, held_out boolean, ids binary, docs binary, local int, word long, n long"
    )
    # a bucket for each task that reads texts
    return staged_buckets(made, "block", max(1, rows.rdd.getNumPartitions()), "coded-texts")


def _packed_words(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as stream:
        stream.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked_words(column: pa.ChunkedArray, schema: pa.Schema) -> tuple[pa.Table, np.ndarray]:
    """Words of packed rows one after the other, and where each row begins."""
    tables = [pa.ipc.open_stream(raw.as_buffer()).read_all() for raw in column if raw.is_valid]
    tables = [pa.Table.from_arrays(t.columns, schema=schema) for t in tables]
    first = np.concatenate(([0], np.cumsum([t.num_rows for t in tables], dtype=np.int64)))
    return pa.concat_tables([schema.empty_table(), *tables]).combine_chunks(), first


def _by_part(table: pa.Table, parts: int) -> dict[int, pa.Table]:
    """The rows of a table with a column ``word`` by the part of the vocabulary they belong to."""
    if not table.num_rows:
        return {}
    part = (table.column("word").to_numpy().view(np.uint64) % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    ends = np.searchsorted(part[order], np.arange(parts + 1)).tolist()
    table = table.take(order)
    return {p: table.slice(a, b - a) for p, (a, b) in enumerate(zip(ends, ends[1:])) if a < b}


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """All rows of one part at a time, of rows sorted by it."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        part = batch.column("part").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
        for a, b in zip(cuts, cuts[1:]):
            if a < b:
                if held and held[0].column("part")[0].as_py() != part[a]:
                    yield pa.Table.from_batches(held)
                    held = []
                held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _placed(packed: DataFrame) -> DataFrame:
    return packed.repartition("part").sortWithinPartitions("part")


_COUNTED = pa.schema(
    [("local", pa.int32()), ("word", pa.int64()), ("n", pa.int64()), ("trained", pa.bool_()), ("first", pa.bool_())]
)


def _word_counts(coded: DataFrame) -> tuple[DataFrame, int]:
    """``(block, part, words)``: the words of blocks by part, with their counts in all training texts,
    and the number of parts.

    Words without any are left out; ``trained`` says whether the block has the word in such a
    text, and ``first`` is set once per word.
    """
    rows = coded.where("word is not null").select("block", "local", "word", "n")
    parts = max(1, -(-rows.count() // PART_WORDS))
    schema = "block long, part int, words binary"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def written():
            table = pa.Table.from_batches(held)
            block = table.column("block").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(block)]
            for a, b in zip(cuts, cuts[1:]):
                made = _by_part(table.slice(a, b - a).select(["local", "word", "n"]), parts)
                yield _batch(
                    _PACKED,
                    block=np.full(len(made), block[a]),
                    part=list(made),
                    words=[_packed_words(t) for t in made.values()],
                )

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.num_rows
            if size > PACKED_ROWS:
                yield from written()
                held, size = [], 0
        if held:
            yield from written()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _parts(batches):
            words, at = _unpacked_words(rows.column("words"), pa.schema(list(_COUNTED)[:3]))
            word, n = words.column("word").to_numpy(), words.column("n").to_numpy()
            order = np.argsort(word, kind="stable")
            start = _starts(word[order])
            times = np.diff(np.append(start, len(word)))
            total, first = np.empty(len(word), np.int64), np.zeros(len(word), bool)
            total[order] = np.repeat(np.add.reduceat(n[order], start), times)
            first[order[start]] = True
            columns = [words.column("local"), word, total, n > 0, first]
            made = pa.Table.from_arrays([c if isinstance(c, pa.ChunkedArray) else pa.array(c) for c in columns], schema=_COUNTED)
            packed = []
            for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
                packed.append(_packed_words(made.slice(a, b - a).filter(pa.array(total[a:b] > 0))))
            yield _batch(_PACKED, block=rows.column("block").to_numpy(), part=rows.column("part").to_numpy(), words=packed)

    return staged(_placed(rows.mapInArrow(pack, schema)).mapInArrow(count, schema), "word-counts"), parts


def _starts(word: np.ndarray) -> np.ndarray:
    """Where each run of equal words begins."""
    return np.flatnonzero(np.concatenate((np.ones(min(1, len(word)), bool), word[1:] != word[:-1])))


def _most_frequent(counts: DataFrame, most: int) -> np.ndarray:
    """The ``most`` most frequent words of those seen more than once."""

    def top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            words, _ = _unpacked_words(batch.column("words"), _COUNTED)
            own_n = words.column("n").to_numpy()
            chosen = words.column("first").to_numpy() & (own_n > 1)
            word = np.concatenate((word, words.column("word").to_numpy()[chosen]))
            n = np.concatenate((n, own_n[chosen]))
            order = np.lexsort((word, -n))[:most]
            word, n = word[order], n[order]
        yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(n)], ["word", "n"])

    found = counts.select("words").mapInArrow(top, "word long, n long")
    return found.orderBy(F.desc("n"), "word").limit(most).toArrow()["word"].to_numpy()


class Core:
    """The most frequent words, by hash, and a number for each (later: its class)."""

    def __init__(self, words: np.ndarray):
        self.words = np.sort(words.view(np.uint64))

    def find(self, h: np.ndarray, values: np.ndarray, other: int) -> np.ndarray:
        if not len(self.words):
            return np.full(len(h), other)
        at = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
        return np.where(self.words[at] == h, values[at], other)


def _before(values: np.ndarray, first: np.ndarray, end: int) -> np.ndarray:
    """The value before each word; ``end`` at the start of a text."""
    out = np.concatenate(([end], values[:-1])) if len(values) else values
    starts = first[:-1]
    out[starts[starts < first[1:]]] = end
    return out


def _after(values: np.ndarray, first: np.ndarray, end: int) -> np.ndarray:
    out = np.concatenate((values[1:], [end])) if len(values) else values
    ends = first[1:]
    out[ends[ends > first[:-1]] - 1] = end
    return out


def _core_bigrams(texts: DataFrame, core: Core) -> np.ndarray:
    """Counts of neighbours among core words, other words and the end (the last two rows)."""
    n = len(core.words)
    width = n + 2

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width * width, np.int64)
        for batch in batches:
            for _, _, words in chunks(batch.column(0)):
                ids = core.find(words.hash, np.arange(n), n)
                left = _before(ids, words.first, n + 1)
                last = ids[words.first[1:][words.per_text > 0] - 1]
                pairs = np.concatenate((left * width + ids, last * width + n + 1))
                pair, times = np.unique(pairs, return_counts=True)
                total[pair] += times
                total[-1] += int((words.per_text == 0).sum())
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["pair", "n"])

    counts = texts.mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    found = counts.toArrow()
    out = np.zeros(width * width)
    out[found["pair"].to_numpy()] = found["n"].to_numpy()
    return out.reshape(width, width)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def exchange(bigrams: np.ndarray, classes: int = CLASSES, passes: int = PASSES) -> np.ndarray:
    """Class of each core word; ``bigrams`` has other words and the end as its last rows.

    A word is taken out of its class and put where the likelihood of the class bigrams,
    ``sum f(n(a, b)) - sum f(n(a, .)) - sum f(n(., b))`` with ``f(x) = x log x``, is highest.
    """
    n = len(bigrams) - 2
    # frequent words first, so their classes differ from the start
    frequency = bigrams[:n].sum(axis=1) + bigrams[:, :n].sum(axis=0)
    order = np.argsort(-frequency, kind="stable")
    of = np.zeros(n + 2, np.int64)
    of[order] = np.arange(n) % classes
    of[n:] = classes, classes + 1
    member = np.zeros((n + 2, classes + 2))
    member[np.arange(n + 2), of] = 1
    table = member.T @ bigrams @ member
    for _ in range(passes):
        moved = 0
        for w in order.tolist():
            right = np.bincount(of, weights=bigrams[w], minlength=classes + 2)
            left = np.bincount(of, weights=bigrams[:, w], minlength=classes + 2)
            self_pairs, old = bigrams[w, w], of[w]
            right[old] -= self_pairs
            left[old] -= self_pairs
            table[old, :] -= right
            table[:, old] -= left
            table[old, old] -= self_pairs
            c = np.arange(classes)
            rows, columns = table[:classes], table[:, :classes]
            gain = (_xlogx(rows + right) - _xlogx(rows)).sum(axis=1)
            gain += (_xlogx(columns + left[:, None]) - _xlogx(columns)).sum(axis=0)
            # the cell of a class with itself takes both sides at once
            own, r, s = table[c, c], right[:classes], left[:classes]
            gain += _xlogx(own + r + s + self_pairs) - _xlogx(own + r) - _xlogx(own + s) + _xlogx(own)
            for side, add in ((rows.sum(axis=1), right.sum()), (columns.sum(axis=0), left.sum())):
                gain -= _xlogx(side + add + self_pairs) - _xlogx(side)
            new = int(gain.argmax())
            moved += new != old
            of[w] = new
            table[new, :] += right
            table[:, new] += left
            table[new, new] += self_pairs
        if not moved:
            break
    return of[:n]


_CONTEXTS = (
    ("block", pa.int64()),
    ("local", pa.int32()),
    ("word", pa.int64()),
    ("class", pa.int64()),
    ("contexts", pa.binary()),
    ("counts", pa.binary()),
    ("known", pa.int64()),
    ("pair", pa.int64()),
    ("n", pa.int64()),
)


def _block_contexts(texts: pa.Table, state: pa.Table) -> pa.Table:
    """Contexts, by class, of a block's words whose turn it is; its counts of neighbouring classes.

    Contexts are coded as pairs (before, after); a word met often has its counts of classes
    before and after instead.
    """
    schema = pa.schema(_CONTEXTS)
    if not texts.num_rows:
        return schema.empty_table()
    ids = np.concatenate([_from_planes(raw) for raw in texts.column("ids")])
    state = state.sort_by("local")
    local, of, turn = (state.column(c).to_numpy() for c in ("local", "class", "turn"))
    # the last place is that of the mark -1 at the end of a text
    classes = np.full(max(ids.max(initial=-1), local.max(initial=-1)) + 2, ONCE, np.uint8)
    classes[local], classes[-1] = of, END
    here = classes[ids]
    before = np.concatenate((np.array([END], np.uint8), here[:-1]))
    after = np.concatenate((here[1:], np.array([END], np.uint8)))
    pairs = np.bincount(before.astype(np.uint16) * ALL + here, minlength=ALL * ALL)
    some = np.flatnonzero(pairs)
    out = [_batch(_CONTEXTS, block=_block_of(texts, len(some)), pair=some, n=pairs[some])]
    # occurrences of the words whose turn it is, by word
    turned = np.zeros(len(classes), bool)
    turned[local[turn]] = True
    at = np.flatnonzero(turned[ids])
    at = np.sort(ids[at].astype(np.int64) << 32 | at)
    n = np.bincount(at >> 32, minlength=len(classes))[local]
    at &= (1 << 32) - 1
    met = turn & (n > 0)
    n, rows = n[met], np.flatnonzero(met)
    first = np.concatenate(([0], np.cumsum(n)))
    before, after = before[at], after[at]
    # neighbours that have a class
    classed = (before < CLASSES).astype(np.int64) + (after < CLASSES)
    known = np.add.reduceat(classed, first[:-1]) if len(n) else np.zeros(0, np.int64)
    word, block = state.column("word").to_numpy(), _block_of(texts, len(n))

    def shown(chosen, **column):
        own = rows[chosen]
        common = {"block": block[chosen], "local": local[own], "word": word[own], "class": of[own], "known": known[chosen]}
        out.append(_batch(_CONTEXTS, **common, **column))

    often = np.flatnonzero(n > OFTEN)
    counts = np.zeros((len(often), 2, ALL), np.int32)
    for own, a, b in zip(counts, first[often].tolist(), first[often + 1].tolist()):
        own[:] = [np.bincount(value[a:b], minlength=ALL) for value in (before, after)]
    shown(often, counts=_packed(counts.ravel(), np.arange(1, len(often) + 1) * 2 * ALL))
    seldom = n <= OFTEN
    code = (before.astype(np.uint16) * ALL + after)[np.repeat(seldom, n)]
    shown(np.flatnonzero(seldom), contexts=_packed(code, np.cumsum(n[seldom])))
    return pa.Table.from_batches(out, schema)


def _block_of(texts: pa.Table, rows: int) -> np.ndarray:
    return np.full(rows, texts.column("block")[0].as_py())


def _gains(table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gain of a word in each class: by class before and after, and by pairs of both."""
    table = table + 0.5
    size = np.log(table.sum(axis=1))
    k = np.arange(CLASSES)
    before = np.rint(UNIT * (np.log(table[:, k]) - size[k]))
    after = np.rint(UNIT * (np.log(table[k].T) - size[k]))
    pairs = (before[:, None, :] + after[None, :, :]).reshape(ALL * ALL, CLASSES)
    return np.concatenate((before, after)), pairs.astype(np.int32)


_STATE = pa.schema([("local", pa.int32()), ("word", pa.int64()), ("class", pa.int8())])
_CONTEXT = pa.schema([f for f in _CONTEXTS if f[0] in ("local", "word", "class", "known", "contexts", "counts")])
_PASS = (*_PACKED, ("rest", pa.binary()), ("pair", pa.int64()), ("n", pa.int64()))
_STEPPED = (*_PACKED, ("seen", pa.int64()), ("moved", pa.int64()))


def _turn(word: np.ndarray, number: int) -> np.ndarray:
    """Whether it is a word's turn in a pass: all in the first one, later half of them.

    The hash is that of Spark's ``xxhash64(word, number)``.
    """
    if not number:
        return np.ones(len(word), bool)
    p1, p2, p3, p4, p5 = (
        np.uint64(p)
        for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
    )

    def rotated(x: np.ndarray, by: int) -> np.ndarray:
        return (x << np.uint64(by)) | (x >> np.uint64(64 - by))

    def mixed(x: np.ndarray) -> np.ndarray:
        x = (x ^ (x >> np.uint64(33))) * p2
        x = (x ^ (x >> np.uint64(29))) * p3
        return x ^ (x >> np.uint64(32))

    h = rotated(word.view(np.uint64) * p2, 31) * p1 ^ np.uint64((42 + int(p5) + 8) % 2**64)
    h = mixed(rotated(h, 27) * p1 + p4)
    h = h + np.uint64((int(p5) + 4) % 2**64) ^ np.uint64(number * int(p1) % 2**64)
    return mixed(rotated(h, 23) * p2 + p3) & np.uint64(1) == 0


def _pass_contexts(texts: pa.Table, state: pa.Table, number: int, parts: int) -> pa.Table:
    """:func:`_block_contexts` by part, with the ``rest`` of the words, whose turn it is not."""
    schema = pa.schema(_PASS)
    if not texts.num_rows:
        return schema.empty_table()
    own, _ = _unpacked_words(state.column("words"), _STATE)
    turn = _turn(own.column("word").to_numpy(), number)
    made = _block_contexts(texts, own.append_column("turn", pa.array(turn)))
    pairs = made.filter(made["word"].is_null())
    words = _by_part(made.filter(made["word"].is_valid()).select(_CONTEXT.names), parts)
    rest = _by_part(own.filter(pa.array(~turn)), parts)
    out = [_batch(_PASS, **{c: pairs.column(c).combine_chunks() for c in ("block", "pair", "n")})]
    both = sorted(words.keys() | rest.keys())
    none = _CONTEXT.empty_table(), _STATE.empty_table()
    packed = [[_packed_words(made.get(p, empty)) for p in both] for made, empty in zip((words, rest), none)]
    out.append(_batch(_PASS, block=_block_of(texts, len(both)), part=both, words=packed[0], rest=packed[1]))
    return pa.Table.from_batches(out, schema)


def _step(contexts: DataFrame, table: np.ndarray) -> DataFrame:
    """The state of the words of ``contexts`` after each whose turn it is has gone to its best class.

    A task adds up the gains over a word's blocks, a part of the vocabulary at a time.
    ``seen`` and ``moved`` count the words whose turn it was.
    """
    shared = contexts.sparkSession.sparkContext.broadcast(_gains(table))

    def best_classes(words: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """New class, whether it is a word's first row, and whether it moved, for words in order."""
        sides, pairs = shared.value
        word, of, known = (words.column(c).to_numpy() for c in ("word", "class", "known"))
        contexts, counts = (words.column(c).combine_chunks() for c in ("contexts", "counts"))
        start = _starts(word)
        first = np.zeros(len(word), bool)
        first[start] = True
        new = np.empty(len(word), np.int64)
        # runs of whole words
        edges = np.append(start, len(word))[np.searchsorted(start, np.arange(0, len(word), STEP_ROWS))]
        edges = np.unique(np.append(edges, len(word))).tolist()
        for a, b in zip(edges, edges[1:]):
            begin = _starts(word[a:b])
            total = _summed(sides, pairs, contexts.slice(a, b - a), counts.slice(a, b - a), begin)
            seen = np.add.reduceat(known[a:b], begin)
            own, name = of[a:b][begin].astype(np.int64), word[a:b][begin]
            best = total.argmax(axis=1)
            # words only met between words without a class are spread, or they stayed together
            alike = (seen == 0) & (own == ONCE)
            best = np.where(alike, (name.view(np.uint64) % np.uint64(CLASSES)).astype(np.int64), best)
            # of equal gains the class of before
            same = (own < CLASSES) & (total[np.arange(len(begin)), np.minimum(own, CLASSES - 1)] == total.max(axis=1))
            best = np.where(same, own, best)
            new[a:b] = np.repeat(best, np.diff(np.append(begin, b - a)))
        return new, first, new != of

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _parts(batches):
            words, at = _unpacked_words(rows.column("words"), _CONTEXT)
            rest, rest_at = _unpacked_words(rows.column("rest"), _STATE)
            order = np.argsort(words.column("word").to_numpy(), kind="stable")
            new, first, moved = (np.empty(len(order), t) for t in (np.int8, bool, bool))
            new[order], first[order], moved[order] = best_classes(words.take(order))
            made = words.select(["local", "word"]).append_column("class", pa.array(new))
            packed, seen, gone = [], [], []
            for a, b, c, d in zip(*(x.tolist() for x in (at[:-1], at[1:], rest_at[:-1], rest_at[1:]))):
                packed.append(_packed_words(pa.concat_tables([made.slice(a, b - a), rest.slice(c, d - c)])))
                seen.append(int(first[a:b].sum()))
                gone.append(int((first & moved)[a:b].sum()) if b > a else 0)
            block, part = (rows.column(c).to_numpy() for c in ("block", "part"))
            yield _batch(_STEPPED, block=block, part=part, words=packed, seen=seen, moved=gone)

    placed = _placed(contexts.where("words is not null").select("block", "part", "words", "rest"))
    return placed.mapInArrow(step, "block long, part int, words binary, seen long, moved long")


def _summed(
    sides: np.ndarray, pairs: np.ndarray, contexts: pa.Array, counts: pa.Array, begin: np.ndarray | None = None
) -> np.ndarray:
    """Sum of the gains of the contexts of each row, or of each run of rows that begins at ``begin``."""
    rows = len(contexts)
    begin = np.arange(rows) if begin is None else begin
    run = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, rows)))
    often = counts.is_valid().to_numpy(zero_copy_only=False)
    code, first = _unpacked(contexts.drop_null(), np.uint16)
    length = np.zeros(rows, np.int64)
    length[~often] = np.diff(first)
    n = np.bincount(run, weights=length, minlength=len(begin)).astype(np.int64)
    first = np.cumsum(n) - n
    out = np.zeros((len(begin), CLASSES), np.int64)
    few = n <= SELDOM
    few[run[often]] = False
    chosen = np.flatnonzero(few)
    for k in range(SELDOM):
        chosen = chosen[n[chosen] > k]
        out[chosen] += pairs[code[first[chosen] + k]]
    many = np.flatnonzero(~few)
    place = np.zeros(len(begin), np.int64)
    place[many] = np.arange(len(many))
    code = code[np.repeat(~few, n)]
    at = np.repeat(np.arange(len(many)) * (2 * ALL), n[many])
    before, after = np.divmod(code, np.uint16(ALL))
    met = np.bincount(np.concatenate((at + before, at + ALL + after)), minlength=len(many) * 2 * ALL)
    met = met.reshape(-1, 2 * ALL).astype(float)
    own, _ = _unpacked(counts.drop_null(), np.int32)
    np.add.at(met, place[run[often]], own.reshape(-1, 2 * ALL))
    out[many] = met @ sides
    return out


def likelihood(table: np.ndarray) -> float:
    """Log likelihood of class bigrams with these counts, given the words."""
    return float(_xlogx(table).sum() - _xlogx(table.sum(axis=0)).sum() - _xlogx(table.sum(axis=1)).sum())


def _counted(pairs: DataFrame) -> np.ndarray:
    found = pairs.groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(ALL * ALL)
    out[found["pair"].to_numpy()] = found["n"].to_numpy()
    return out.reshape(ALL, ALL)


def exchange_all(texts: DataFrame, state: DataFrame, parts: int) -> DataFrame:
    """``state`` after exchange passes over all its words.

    ``texts`` has the coded texts of blocks, ``state`` the packed words of blocks with their
    classes.
    """
    best, number = None, 0
    while True:
        # words that stand beside each other would change places for ever, did they not take turns
        contexts = staged(
            texts.groupBy("block")
            .cogroup(state.select("block", "words").groupBy("block"))
            .applyInArrow(
                functools.partial(_pass_contexts, number=number, parts=parts),
                "block long, part int, words binary, rest binary, pair long, n long",
            ),
            "contexts",
        )
        table = _counted(contexts.where("pair is not null").select("pair", "n"))
        reached = likelihood(table)
        # before the first pass words outside the core have no class to keep
        if number > 1 and reached <= best[0]:
            discard(contexts)
            discard(state)
            return best[1]
        if number:
            discard(best[1])
        best = reached, state
        state = staged(_step(contexts, table), "classes")
        discard(contexts)
        words, moved = state.agg(F.sum("seen"), F.sum("moved")).first()
        if moved <= FEW * words:
            discard(best[1])
            return state
        number += 1


@dataclass
class ClassModel:
    """What scoring needs besides the vocabulary: totals, emissions and transitions."""

    tokens: int
    distinct: int
    texts: int
    once: int
    twice: int
    class_total: np.ndarray  # training words of each class
    transitions: np.ndarray | None = None  # log10 P(class | class before)

    @property
    def unseen_share(self) -> float:
        """Share of unknown words in the class of rare words."""
        return (self.once + 1) / (self.once + 2 * self.twice + 2)

    def base(self, n: np.ndarray) -> np.ndarray:
        return np.log10((n + 0.5) / (self.tokens + 0.5 * (self.distinct + 1)))

    def emission(self, n: np.ndarray, of: np.ndarray) -> np.ndarray:
        """log10 P(word | class); ``n`` is 0 for unknown words, which are of class ONCE."""
        total = np.maximum(self.class_total, 1)[of]
        p = np.where(of == ONCE, (1 - self.unseen_share) / max(self.once, 1), n / total)
        p = np.where(n == 0, self.unseen_share if self.once else 1.0, p)
        return np.log10(np.where(of == END, 1.0, p))

    def with_transitions(self, counts: np.ndarray) -> ClassModel:
        frequency = counts.sum(axis=0) + 0.5
        smoothed = counts + SMOOTHING * frequency / frequency.sum()
        self.transitions = np.log10(smoothed / smoothed.sum(axis=1, keepdims=True))
        return self


_SCORED = pa.schema(
    [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64())]
    + [("base_score", pa.float64()), ("emission", pa.float64()), ("classes", pa.binary())]
)


def _block_scores(model: ClassModel, texts: pa.Table, vocabulary: pa.Table) -> pa.Table:
    """Everything about a block's texts but the transitions, and their class sequences."""
    local = vocabulary.column("local").to_numpy()
    out = []
    for held_out, ids, docs in zip(*(texts.column(c) for c in ("held_out", "ids", "docs"))):
        doc_id = pa.ipc.open_stream(docs.as_buffer()).read_all().column("doc_id").combine_chunks()
        ids = _from_planes(ids)
        # the last place is that of the mark -1 at the end of a text
        size = max(ids.max(initial=-1), local.max(initial=-1)) + 2
        n, of = np.zeros(size, np.int64), np.full(size, ONCE, np.uint8)
        n[local], of[local] = vocabulary.column("n").to_numpy(), vocabulary.column("class").to_numpy()
        n[-1], of[-1] = model.texts, END
        ends = np.flatnonzero(ids < 0) + 1
        first = np.concatenate(([0], ends[:-1]))
        columns = (
            doc_id,
            pa.array([held_out.as_py()] * len(ends)),
            ends - first,
            np.add.reduceat((n > 0).astype(np.int64)[ids], first),
            np.add.reduceat(model.base(n)[ids], first),
            np.add.reduceat(model.emission(n, of)[ids], first),
            _packed(of[ids], ends),
        )
        out.append(_batch([(f.name, f.type) for f in _SCORED], **dict(zip(_SCORED.names, columns))))
    return pa.Table.from_batches(out, _SCORED)


def _sequences(classes: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Class bigrams, as before * ALL + after, of some texts one after the other; where each begins."""
    after, first = _unpacked(classes, np.uint8)
    # a text ends with END, which stands before the next one's first word
    before = np.concatenate((np.array([END], np.uint8), after[:-1]))
    return before[: len(after)].astype(np.uint16) * ALL + after, first


def _transitions(scored: DataFrame) -> np.ndarray:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(ALL * ALL, np.int64)
        for batch in batches:
            total += np.bincount(_sequences(batch.column(0))[0], minlength=ALL * ALL)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["pair", "n"])

    rows = scored.where("not held_out").select("classes").mapInArrow(count, "pair long, n long")
    return _counted(rows)


_CLASSED = pa.schema([*list(_COUNTED)[:3], ("class", pa.int8()), ("first", pa.bool_())])


def block_classes(training: DataFrame, coded: DataFrame) -> DataFrame:
    """``(block, part, words)``: the words of blocks with their counts and classes, written."""
    counts, parts = _word_counts(coded)
    core = Core(_most_frequent(counts, CORE))
    of = exchange(_core_bigrams(training, core))

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for raw in batch.column("words"):
                words, _ = _unpacked_words([raw], _COUNTED)
                words = words.filter(pa.array(words.column("trained").to_numpy() & (words.column("n").to_numpy() > 1)))
                own = core.find(words.column("word").to_numpy().view(np.uint64), of, ONCE)
                words = words.select(["local", "word"]).append_column("class", pa.array(own.astype(np.int8)))
                made.append(_packed_words(words))
            yield _batch(_PACKED, block=batch.column("block"), part=batch.column("part"), words=made)

    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _parts(batches):
            known, _ = _unpacked_words(rows.column("state"), _STATE)
            word, at = np.unique(known.column("word").to_numpy(), return_index=True)
            own_class = known.column("class").to_numpy()[at]
            for block, part, raw in zip(*(rows.column(c) for c in ("block", "part", "words"))):
                if not raw.is_valid:
                    continue
                words, _ = _unpacked_words([raw], _COUNTED)
                asked = words.column("word").to_numpy()
                found = np.full(len(asked), ONCE, np.int8)
                if len(word):
                    place = np.minimum(np.searchsorted(word, asked), len(word) - 1)
                    found = np.where(word[place] == asked, own_class[place], found)
                words = words.drop_columns(["trained"]).add_column(3, "class", pa.array(found))
                yield _batch(_PACKED, block=[block.as_py()], part=[part.as_py()], words=[_packed_words(words)])

    state = None
    both = counts.withColumn("state", F.lit(None).cast("binary"))
    if len(core.words):
        texts = coded.where("ids is not null and not held_out").select("block", "ids")
        state = staged(counts.mapInArrow(begin, "block long, part int, words binary"), "classes")
        state = exchange_all(texts, state, parts)
        both = both.union(state.select("block", "part", F.lit(None).cast("binary"), "words"))
    made = staged(_placed(both).mapInArrow(give, "block long, part int, words binary"), "vocabulary")
    for table in (counts, state):
        if table is not None:
            discard(table)
    return made


def words_of_blocks(classes: DataFrame) -> DataFrame:
    """``(word, n, class)``, a row per word, of packed words."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, _ = _unpacked_words(batch.column("words"), _CLASSED)
            words = words.filter(words.column("first")).select(["word", "n", "class"])
            yield from words.set_column(2, "class", words.column("class").cast(pa.int64())).to_batches()

    return classes.select("words").mapInArrow(unpack, "word long, n long, class long")


def class_vocabulary(training: DataFrame, coded: DataFrame) -> DataFrame:
    """``(word, n, class)`` of all words of the training texts."""
    return words_of_blocks(block_classes(training, coded))


def class_scores(
    docs: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document with its counts, base score and log10 probability.

    ``held_out`` is a condition over the columns of ``docs``; the model learns from the
    other rows.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        F.col(text).alias("text"),
    )
    training = rows.where("not held_out").select("text")
    coded = _coded(rows)
    classes = block_classes(training, coded)
    totals = words_of_blocks(classes).groupBy("class").agg(
        F.sum("n").alias("n"),
        F.count("*").alias("distinct"),
        F.count_if(F.col("n") == 1).alias("once"),
        F.count_if(F.col("n") == 2).alias("twice"),
    ).collect()
    texts = training.count()
    class_total = np.zeros(ALL)
    for row in totals:
        class_total[row["class"]] = row["n"]
    model = ClassModel(
        sum(row["n"] for row in totals) + texts,
        sum(row["distinct"] for row in totals) + (texts > 0),
        texts,
        sum(row["once"] for row in totals),
        sum(row["twice"] for row in totals),
        class_total,
    )

    def block_scores(texts: pa.Table, words: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return _SCORED.empty_table()
        return _block_scores(model, texts, _unpacked_words(words.column("words"), _CLASSED)[0])

    scored = (
        coded.where("ids is not null")
        .select("block", "held_out", "ids", "docs")
        .groupBy("block")
        .cogroup(classes.select("block", "words").groupBy("block"))
        .applyInArrow(
            block_scores,
            "doc_id long, held_out boolean, n_tokens long, n_known long, "
            "base_score double, emission double, classes binary",
        )
    )
    scored = staged(scored, "class-sequences")
    discard(coded)
    discard(classes)
    model = model.with_transitions(_transitions(scored))
    log_p = model.transitions.ravel()

    @F.arrow_udf("double")
    def walked(classes: pa.Array) -> pa.Array:
        pairs, first = _sequences(classes)
        return pa.array(np.add.reduceat(log_p[pairs], first[:-1]) if len(pairs) else [], pa.float64())

    return scored.select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score",
        (F.col("emission") + walked("classes")).alias("score"),
    )
