"""Spelling variants: words of a corpus one insertion, deletion or replacement apart.

Words are maximal runs of ``A-Z a-z À-ÿ``, A-Z lower-cased; such a word has a byte per code
point in Latin-1, and so it is held.  Letters fall into :data:`GROUPS` groups, and a word is
the vector of how many letters of each group it has, one after the other: its way down a
trie.  One edit takes away at most one letter of a group (deficit) and adds at most one
(surplus), so words that are near lie where a search from the root arrives that spends one
of each at most.

Trie and search are dealt by the counts of the first :data:`PLACED` groups (a cell).  A word
lives in its own cell, cut into parts of at most :data:`PART` words, and searches all parts of
those cells within its budget that do not come before its own, so a pair is met once.  The
table of cells is bounded, as counts above :data:`TOP` are one there.  In a task the words of
a part form the deeper levels, and searching words go down them depth first, many words at a
time.  Near words share the first or the last half of the shorter one; words of a leaf are
looked up by those halves and then compared letter by letter.  Only counts and the best near
word of each word leave a task, never pairs.

Null and empty texts have no words.  Very long texts are used whole, and very long runs are
words like others.  A document without an id counts as one with an empty id.  Repeated rows
count each.  Ties for the largest count go to the smallest word in code-point order.
Further columns are left out, whatever their names.  An empty table gives no words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stormgauge.llm.common import small_batches, staged
from stormgauge.llm.words import mix

LEAST_CHARS = 7
LEAST_COUNT = 2
TIMES = 10
GROUPS = 8
PLACED = 4
TOP = 15
PART = 200_000
# words counted in a task before they are handed on, and words that search at a time
COUNTED = 500_000
SEARCHING = 20_000
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_BYTE = np.random.default_rng(31).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
# letters from frequent to rare, dealt to the groups in turn; others by their code point
_LETTERS = "etaoinsrhldcumfpgwybvkxjqz"
_GROUP = np.arange(256) % GROUPS
_GROUP[[ord(c) for c in _LETTERS]] = np.arange(len(_LETTERS)) % GROUPS


def counted_words(docs: DataFrame, doc_id: str, text: str, least: int, thin: int = 31) -> DataFrame:
    """``(word, n)`` with words in Latin-1, over all documents.

    Where ``thin`` divides the crc32 ``h`` of ``<doc_id>:<run>``, the run loses its letter
    ``h % length``.
    """
    schema = pa.schema([("word", pa.binary()), ("n", pa.int64())])
    runs = re.compile("[A-Za-zÀ-ÿ]{%d,}" % least)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def made():
            columns = [pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())]
            return pa.RecordBatch.from_arrays(columns, schema=schema)

        for batch in batches:
            for own, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                start = zlib.crc32(f"{own}:".encode())
                lowered = body.encode().lower().decode()
                for run, n in Counter(runs.findall(lowered)).items():
                    h = zlib.crc32(run.encode(), start)
                    word = run.encode("latin-1")
                    if h % thin == 0:
                        k = h % len(word)
                        word = word[:k] + word[k + 1 :]
                    if len(word) >= least:
                        total[word] += n
                if len(total) > COUNTED:
                    yield made()
                    total.clear()
        if total:
            yield made()

    slim = docs.where(F.length(text) >= least).select(
        F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.col(text)
    )
    return slim.mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


class WordList:
    """Words side by side as bytes, with hashes of any stretch."""

    def __init__(self, words: list[bytes]):
        self.length = np.array([len(w) for w in words], np.int64)
        self.data = np.frombuffer(b"".join(words), np.uint8)
        self.start = np.cumsum(self.length) - self.length
        n = len(self.data)
        power = np.concatenate(([np.uint64(1)], np.cumprod(np.full(max(n, 1), _BASE, np.uint64))))
        self.inverse = np.concatenate(
            ([np.uint64(1)], np.cumprod(np.full(max(n, 1), _INVERSE, np.uint64)))
        )
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[self.data] * power[:n], out=self.sums[1:])

    def hash(self, which: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
        begin = self.start[which] + first
        return mix((self.sums[begin + length] - self.sums[begin]) * self.inverse[begin])

    def vectors(self) -> np.ndarray:
        """How many letters of each group a word has, a row per word."""
        cell = np.repeat(np.arange(len(self.length)), self.length) * GROUPS + _GROUP[self.data]
        counts = np.bincount(cell, minlength=len(self.length) * GROUPS)
        return counts.reshape(-1, GROUPS)


def shared_lengths(
    x: WordList, i: np.ndarray, y: WordList, j: np.ndarray, backwards: bool = False
) -> np.ndarray:
    """Letters that the words of each pair share from their begin, or from their end."""
    least = np.minimum(x.length[i], y.length[j])
    out = np.zeros(len(i), np.int64)
    if backwards:
        at_x, at_y, step = x.start[i] + x.length[i] - 1, y.start[j] + y.length[j] - 1, -1
    else:
        at_x, at_y, step = x.start[i], y.start[j], 1
    open_ = np.arange(len(i))
    while len(open_):
        open_ = open_[out[open_] < least[open_]]
        k = step * out[open_]
        open_ = open_[x.data[at_x[open_] + k] == y.data[at_y[open_] + k]]
        out[open_] += 1
    return out


class Trie:
    """Words of a part in the order of their vectors; a node is a stretch of that order."""

    def __init__(self, words: list[bytes], counts: np.ndarray):
        vectors = WordList(words).vectors()
        order = np.lexsort(vectors.T[::-1]).tolist()
        self.names = [words[k] for k in order]
        self.counts = counts[order]
        self.words, self.vectors = WordList(self.names), vectors[order]
        fresh = np.ones(len(order), bool)
        fresh[1:] = (self.vectors[1:] != self.vectors[:-1]).any(axis=1)
        self.leaf_start = np.flatnonzero(fresh)
        self.leaf = np.cumsum(fresh) - 1
        self.leaf_length = self.words.length[self.leaf_start]
        # where a level's count or one before it changes, a node of that level begins
        self.begins = []
        change = np.zeros(len(order), bool)
        change[:1] = True
        for level in range(GROUPS):
            change = change.copy()
            change[1:] |= self.vectors[1:, level] != self.vectors[:-1, level]
            self.begins.append(np.flatnonzero(change))
        self._index_halves()

    def _index_halves(self) -> None:
        """Codes of (leaf, end, half) for both lengths that half of the shorter word may have."""
        n = np.arange(len(self.names))
        codes, owners = [], []
        for shorter in (0, 1):
            half = (self.words.length - shorter) // 2
            for end in (0, 1):
                first = self.words.length - half if end else np.zeros_like(half)
                codes.append(self.code(self.leaf, half, end, self.words.hash(n, first, half)))
                owners.append(n)
        code, owner = np.concatenate(codes), np.concatenate(owners)
        order = np.lexsort((owner, code))
        code, owner = code[order], owner[order]
        kept = np.ones(len(code), bool)
        kept[1:] = (code[1:] != code[:-1]) | (owner[1:] != owner[:-1])
        self.code_sorted, self.code_owner = code[kept], owner[kept]

    @staticmethod
    def code(leaf: np.ndarray, half: np.ndarray, end: int, h: np.ndarray) -> np.ndarray:
        place = (leaf.astype(np.uint64) << np.uint64(1)) + np.uint64(end)
        return mix(h + mix(place * np.uint64(_BASE) + half.astype(np.uint64)))

    def arrivals(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(word, leaf)``: where searches with a surplus and a deficit of one arrive."""
        who, where = [], []
        none = np.zeros(len(vectors), np.int8)
        stack = [(0, 0, len(self.names), np.arange(len(vectors)), none, none)]
        while stack:
            level, low, high, q, surplus, deficit = stack.pop()
            if level == GROUPS:
                who.append(q)
                where.append(np.full(len(q), self.leaf[low]))
                continue
            begins = self.begins[level]
            first, last = np.searchsorted(begins, (low, high))
            own = vectors[q, level]
            for k in range(first, last):
                begin = int(begins[k])
                stop = int(begins[k + 1]) if k + 1 < last else high
                more = self.vectors[begin, level] - own
                s, d = surplus + np.maximum(more, 0), deficit + np.maximum(-more, 0)
                kept = np.flatnonzero((s <= 1) & (d <= 1))
                if len(kept):
                    stack.append((level + 1, begin, stop, q[kept], s[kept], d[kept]))
        if not who:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(who), np.concatenate(where)

    def near(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """``(i, j)``: searching word and word of the trie, exactly one edit apart."""
        own = WordList(words)
        q, leaf = self.arrivals(own.vectors())
        length = self.leaf_length[leaf]
        half = np.minimum(own.length[q], length) // 2
        found = []
        for end in (0, 1):
            first = own.length[q] - half if end else np.zeros_like(half)
            code = self.code(leaf, half, end, own.hash(q, first, half))
            low = np.searchsorted(self.code_sorted, code, "left")
            n = np.searchsorted(self.code_sorted, code, "right") - low
            place = np.repeat(low - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
            i, j, halves = np.repeat(q, n), self.code_owner[place], np.repeat(half, n)
            front = shared_lengths(own, i, self.words, j)
            back = shared_lengths(own, i, self.words, j, backwards=True)
            shorter = np.minimum(own.length[i], self.words.length[j])
            longer = np.maximum(own.length[i], self.words.length[j])
            ok = (front + back >= longer - 1) & ((front < shorter) | (longer > shorter))
            if end:
                ok &= front < halves  # others were found by their first half
            found.append((i[ok], j[ok]))
        return tuple(np.concatenate(c) for c in zip(*found))


def _cell(vector: Column) -> Column:
    cell = F.lit(0)
    for k in range(PLACED):
        cell = cell * (TOP + 1) + F.least(vector[k], F.lit(TOP))
    return cell


def cells_searched(cell: int) -> list[int]:
    """Cells from ``cell`` on within a surplus and a deficit of one.

    The top count stands for all above, so there a step stays in the cell as well.
    """
    base = TOP + 1
    counts = [cell // base**k % base for k in range(PLACED)]
    out = {cell}
    for i in range(PLACED):
        for up in (1, -1):
            one = counts[i] + up
            if not 0 <= one <= TOP:
                continue
            moved = cell + up * base**i
            out.add(moved)
            for j in range(PLACED):
                other = counts[j] - up
                if j != i and 0 <= other <= TOP:
                    out.add(moved - up * base**j)
    return sorted(c for c in out if c >= cell)


def _with_cells(words: DataFrame) -> DataFrame:
    """``(word, n, cell)``: counts of the leading groups, in the JVM."""
    text = F.decode("word", "ISO-8859-1")
    groups = [
        "".join(chr(c) for c in [*range(97, 123), *range(0xC0, 0x100)] if _GROUP[c] == k)
        for k in range(PLACED)
    ]
    counts = F.array(
        *(F.length(text) - F.length(F.translate(text, letters, "")) for letters in groups)
    )
    return words.select("word", "n", _cell(counts).cast("int").alias("cell"))


SEARCH_SCHEMA = "word binary, n_near long, best_n long, best binary"


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``(cell, part, kind, word, n, own, number)`` sorted so that a part's words come first.

    ``kind`` 0 lives in the part, 1 searches it; ``own`` tells that the searching word lives
    in this cell, where a pair counts for its smaller word's search only.
    """
    now, living, trie, waiting = None, [], None, []
    n_near = best = None

    def table(names, near, best_n, best_word):
        return pa.RecordBatch.from_arrays(
            [
                pa.array(names, pa.binary()),
                pa.array(near, pa.int64()),
                pa.array(best_n, pa.int64()),
                pa.array(best_word, pa.binary()),
            ],
            ["word", "n_near", "best_n", "best"],
        )

    def found():
        """What the waiting words find; the part's own words keep what was found of them."""
        words, counts, own = (list(c) for c in zip(*waiting))
        i, j = trie.near(words)
        if not len(i):
            return None
        inside = np.array(own, bool)[i]
        once = np.array([not s or words[a] < trie.names[b] for s, a, b in zip(inside, i, j)], bool)
        i, j = i[once], j[once]
        near, top = np.bincount(i, minlength=len(words)), [None] * len(words)
        n_near_ = np.bincount(j, minlength=len(trie.names))
        n_near[:] += n_near_
        for a, b in zip(i.tolist(), j.tolist()):
            mine, other = (-counts[a], words[a]), (-int(trie.counts[b]), trie.names[b])
            if top[a] is None or other < top[a]:
                top[a] = other
            if best[b] is None or mine < best[b]:
                best[b] = mine
        hit = np.flatnonzero(near).tolist()
        return table(
            [words[a] for a in hit],
            near[hit],
            [-top[a][0] for a in hit],
            [top[a][1] for a in hit],
        )

    def living_found():
        hit = np.flatnonzero(n_near).tolist()
        return table(
            [trie.names[b] for b in hit],
            n_near[hit],
            [-best[b][0] for b in hit],
            [best[b][1] for b in hit],
        )

    def close():
        nonlocal waiting
        if trie is not None:
            if waiting:
                made = found()
                waiting = []
                if made is not None:
                    yield made
            yield living_found()

    for batch in batches:
        for cell, part, kind, word, n, own in zip(*(c.to_pylist() for c in batch.columns)):
            if (cell, part) != now:
                yield from close()
                now, living, trie, waiting = (cell, part), [], None, []
            if kind == 0:
                living.append((word, n))
                continue
            if trie is None:
                if not living:
                    continue
                trie = Trie([w for w, _ in living], np.array([c for _, c in living], np.int64))
                living = []
                n_near, best = np.zeros(len(trie.names), np.int64), [None] * len(trie.names)
            waiting.append((word, n, own))
            if len(waiting) >= SEARCHING:
                made = found()
                waiting = []
                if made is not None:
                    yield made
    yield from close()


def near_words(words: DataFrame, part: int = PART) -> DataFrame:
    """``(word, n_near, best_n, best)`` of all words of ``(word, n)`` that have a near one."""
    celled = _with_cells(words)
    held = celled.groupBy("cell").agg(F.ceil(F.count("*") / part).cast("int").alias("parts"))
    # at most (TOP + 1) ** PLACED rows
    held = staged(held, "cells")
    searched = F.udf(lambda cell: cells_searched(cell), "array<int>")
    reached = held.select("cell", F.explode(searched("cell")).alias("to")).join(
        held.select(F.col("cell").alias("to"), F.col("parts").alias("to_parts")), "to"
    )
    living = celled.join(F.broadcast(held), "cell").select(
        "cell",
        F.pmod(F.xxhash64("word"), F.col("parts")).cast("int").alias("part"),
        F.lit(0).alias("kind"),
        "word",
        "n",
        F.lit(True).alias("own"),
    )
    every = F.explode(F.sequence(F.lit(0), F.col("to_parts") - 1))
    searching = celled.join(F.broadcast(reached), "cell").select(
        F.col("to").alias("cell"),
        every.alias("part"),
        F.lit(1).alias("kind"),
        "word",
        "n",
        (F.col("to") == F.col("cell")).alias("own"),
    )
    placed = living.union(searching).repartition("cell", "part")
    placed = placed.sortWithinPartitions("cell", "part", "kind", "word")
    found = placed.mapInArrow(_search, SEARCH_SCHEMA)
    top = F.min(F.struct((-F.col("best_n")).alias("less"), "best"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), top.alias("top")).select(
        "word", "n_near", (-F.col("top.less")).alias("best_n"), F.col("top.best").alias("best")
    )


def followed(forms: DataFrame) -> DataFrame:
    """``(word, root)`` from ``(word, form)``: each form's form in turn, to the last.

    A form is far more frequent than its word, so no way is long; each round doubles it.
    """
    roots = staged(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = roots.join(further, "root", "left")
        moved = staged(
            joined.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
            "roots",
        )
        roots = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return roots


def spelling_variants(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    least_chars: int = LEAST_CHARS,
    least_count: int = LEAST_COUNT,
    times: int = TIMES,
) -> DataFrame:
    """One row ``(word, form, root, n, n_near, form_n)`` per word.

    ``form`` is the near word with the largest count, if that is at least ``times`` the
    word's own; ``root`` is where the forms lead to, the word itself if it has none.
    """
    small_batches(docs.sparkSession)
    words = counted_words(docs, doc_id, text, least_chars).where(F.col("n") >= least_count)
    words = staged(words, "words")
    near = near_words(words)
    made = staged(words.join(near, "word", "left"), "near-words")
    has_form = F.coalesce(F.col("best_n") >= times * F.col("n"), F.lit(False))
    formed = made.where(has_form).select("word", F.col("best").alias("form"))
    roots = followed(formed)
    shown = {c: F.decode(c, "ISO-8859-1") for c in ("word", "form", "root")}
    out = made.join(roots, "word", "left").select(
        "word",
        F.when(has_form, F.col("best")).alias("form"),
        F.coalesce("root", "word").alias("root"),
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(has_form, F.col("best_n")).alias("form_n"),
    )
    return out.withColumns(shown)
