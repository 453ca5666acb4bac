"""Token ids in binary files of bit planes, with a chunk index.

A file holds the ids of consecutive documents in fixed-size chunks.  A chunk is transposed
into planes (plane ``b`` holds bit or byte ``b`` of all its ids), and each plane is
compressed with zstandard, so the high planes of small ids cost next to nothing.  The
footer holds the chunk index (place, id count and plane sizes of every chunk) and the
documents (id and id count), so any range of ids can be read without the rest.

Layout: ``BPL1``, chunks, footer as compressed JSON, footer length (8 bytes), ``BPL1``.

Documents lie in ascending ``doc_id`` order over the files in name order, rows without an
id first; equal ids are ordered by a hash of their text.  Null and empty texts give a
document of the end id alone.  Very long texts are written over several chunks, repeated
rows are written as often as they occur, further columns are left out, and an empty table
gives no documents.
"""

from __future__ import annotations

import functools
import gc
import json
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stormgauge.llm.bpe import byte_characters
from stormgauge.llm.common import small_batches, staged

MAGIC = b"BPL1"
CHUNK_IDS = 1 << 17
LEVEL = 3
REMEMBERED = 400_000
BLOCK_BYTES = 4 << 20
# words the library gets as one text
WORDS_AT_ONCE = 1024


def to_planes(ids: np.ndarray, kind: str = "bit") -> list[bytes]:
    """Planes of a block of ids, lowest first; planes that are zero at the top are left out."""
    top = int(ids.max()) if len(ids) else 0
    if kind == "byte":
        raw = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
        return [raw[:, b].tobytes() for b in range((top.bit_length() + 7) // 8)]
    octets = np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    # what is not zero counts as a bit set
    return [
        np.packbits(octets[b // 8] & np.uint8(1 << b % 8)).tobytes()
        for b in range(top.bit_length())
    ]


def from_planes(planes: list[bytes], count: int, kind: str = "bit") -> np.ndarray:
    ids = np.zeros(count, np.uint32)
    for b, plane in enumerate(planes):
        raw = np.frombuffer(plane, np.uint8)
        if kind == "byte":
            ids |= raw.astype(np.uint32) << np.uint32(8 * b)
        else:
            ids |= np.unpackbits(raw, count=count).astype(np.uint32) << np.uint32(b)
    return ids


class PlaneWriter:
    """Writes one file; ``add`` takes documents in order."""

    def __init__(self, out, kind: str = "bit", chunk_ids: int = CHUNK_IDS):
        self.out, self.kind, self.chunk_ids = out, kind, chunk_ids
        self.pack = zstandard.ZstdCompressor(level=LEVEL)
        self.waiting: list[np.ndarray] = []
        self.n_waiting = self.n_ids = 0
        self.index: list[list[int]] = []
        self.docs: list[list] = [[], []]
        self.place = out.write(MAGIC)

    def add(self, doc_ids: list, counts: list[int], ids: np.ndarray) -> None:
        """Documents with their id counts, and their ids one after the other."""
        self.docs[0] += doc_ids
        self.docs[1] += counts
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        if self.n_waiting >= self.chunk_ids:
            held = np.concatenate(self.waiting)
            full = len(held) // self.chunk_ids * self.chunk_ids
            for i in range(0, full, self.chunk_ids):
                self._chunk(held[i : i + self.chunk_ids])
            self.waiting, self.n_waiting = [held[full:]], len(held) - full

    def _chunk(self, ids: np.ndarray) -> None:
        planes = [self.pack.compress(p) for p in to_planes(ids, self.kind)]
        self.index.append([self.place, len(ids), *map(len, planes)])
        self.place += self.out.write(b"".join(planes)) if planes else 0
        self.n_ids += len(ids)

    def close(self) -> None:
        if self.n_waiting:
            self._chunk(np.concatenate(self.waiting))
        footer = {"kind": self.kind, "index": self.index, "docs": self.docs}
        packed = self.pack.compress(json.dumps(footer).encode())
        self.out.write(packed + len(packed).to_bytes(8, "little") + MAGIC)
        self.out.close()


class PlaneReader:
    """Reads one file through a seekable handle."""

    def __init__(self, file):
        self.file, self.unpack = file, zstandard.ZstdDecompressor()
        size = file.size()
        tail = self._at(size - 12, 12)
        if tail[8:] != MAGIC:
            raise ValueError("not a file of id planes")
        length = int.from_bytes(tail[:8], "little")
        footer = json.loads(self.unpack.decompress(self._at(size - 12 - length, length)))
        self.kind, self.index = footer["kind"], footer["index"]
        self.doc_ids, self.counts = footer["docs"]
        self.ends = np.cumsum([c[1] for c in self.index], dtype=np.int64)

    def _at(self, place: int, length: int) -> bytes:
        self.file.seek(place)
        return self.file.read(length)

    def chunk(self, k: int) -> np.ndarray:
        place, count, *sizes = self.index[k]
        raw, planes, at = self._at(place, sum(sizes)), [], 0
        for size in sizes:
            planes.append(self.unpack.decompress(raw[at : at + size]))
            at += size
        return from_planes(planes, count, self.kind)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids of a range; only the chunks that hold it are read."""
        first = int(np.searchsorted(self.ends, start, "right"))
        last = int(np.searchsorted(self.ends, stop, "left"))
        if start >= stop:
            return np.zeros(0, np.uint32)
        base = int(self.ends[first - 1]) if first else 0
        held = np.concatenate([self.chunk(k) for k in range(first, last + 1)])
        return held[start - base : stop - base]

    def documents(self) -> Iterator[tuple[int, int, np.ndarray]]:
        """``(number, first id, ids)`` of each document in order, a chunk in memory at a time."""
        held, base, k, start = np.zeros(0, np.uint32), 0, 0, 0
        for number, count in enumerate(self.counts):
            parts, need = [], count
            while need:
                if start - base >= len(held):
                    base, held, k = base + len(held), self.chunk(k), k + 1
                part = held[start - base : start - base + need]
                parts.append(part)
                start, need = start + len(part), need - len(part)
            ids = np.concatenate(parts) if parts else held[:0]
            yield number, start - count, ids


# marks at the end of a run behind a letter or digit, which the vocabulary splits off anyway;
# an apostrophe may begin a part of its own
_MARKS = re.compile(
    rb"[!-&(-/:-@\[-`{-~](?<=[a-z0-9].)[!-&(-/:-@\[-`{-~]*(?=[\x20\x09-\x0D]|$)"
)
# a part that is one word for the vocabulary: Latin letters that every normal form keeps
_WORD = re.compile(rb"(?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")


def _runs(text: bytes) -> list[bytes]:
    """Parts that the vocabulary encodes apart: it splits at blanks and lower-cases.

    Only a text that may hold a special token, which is told by its case, stays as it is.
    """
    if b"<|" not in text:
        text = _MARKS.sub(rb" \g<0>", text.lower())
    return text.split()


class _Numbers(dict):
    """Numbers of parts in the order they are first asked for, ``new`` ones listed."""

    def __init__(self, first: bytes):
        super().__init__({first: 0})
        self.new: list[bytes] = []

    def __missing__(self, part: bytes) -> int:
        self[part] = number = len(self)
        self.new.append(part)
        return number


class LibraryEncoder:
    """Ids of texts by the tokenizers library, asked once for every distinct part of a text.

    Parts of Latin letters alone are words to the vocabulary.  The library gets many of them
    at once, in the characters that stand for their bytes, with the same model and without
    the steps that normalise and split texts, which take most of its time and change nothing.
    """

    def __init__(self, path: str, end_id: int):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        # many small lists come and go here; looking for cycles among them only costs time
        gc.disable()
        self.library, self.end_id = Tokenizer.from_file(path), end_id
        self.library.no_truncation()
        self.library.no_padding()
        self.words = Tokenizer(self.library.model)
        self.words.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        # the suffix tells the last id of a word
        suffix = self.library.model.end_of_word_suffix or ""
        vocabulary = self.words.get_vocab(with_added_tokens=False)
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for token, i in vocabulary.items() if suffix and token.endswith(suffix)]] = True
        self.characters = {i: c for c, i in zip(byte_characters(), range(256)) if i != 0x20}
        self._forget()

    def _forget(self) -> None:
        # entry 0 is the end of a document
        self.known = _Numbers(b"")
        self.flat, self.size = np.array([self.end_id], np.uint32), np.array([1])
        self.first = np.array([0])

    def _ids(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Id counts of the parts, and all ids one after the other."""
        found = self.library.encode_batch_fast([p.decode() for p in parts], add_special_tokens=False)
        lists = [f.ids for f in found]
        size = np.fromiter(map(len, lists), np.int64, len(lists))
        return size, np.fromiter(chain.from_iterable(lists), np.uint32, int(size.sum()))

    def _word_ids(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The same for parts that are one word each."""
        sizes, found = [np.zeros(0, np.int64)], [np.zeros(0, np.uint32)]
        for i in range(0, len(words), WORDS_AT_ONCE):
            some = words[i : i + WORDS_AT_ONCE]
            text = b" ".join(some).decode().lower().encode().decode("latin-1")
            text = text.translate(self.characters)
            ids = self.words.encode_batch_fast([text], add_special_tokens=False)[0].ids
            ids = np.array(ids, np.uint32)
            size = np.diff(np.flatnonzero(self.last[ids]), prepend=-1)
            if len(size) != len(some) or size.sum() != len(ids):
                size, ids = self._ids(some)
            sizes.append(size)
            found.append(ids)
        return np.concatenate(sizes), np.concatenate(found)

    def encode(self, texts: list[bytes]) -> tuple[list[int], np.ndarray]:
        """Id counts of the texts with their end ids, and all ids one after the other."""
        if len(self.known) > REMEMBERED:
            self._forget()
        flat: list[bytes] = []
        for t in texts:
            flat += _runs(t)
            flat.append(b"")
        which = np.fromiter(map(self.known.__getitem__, flat), np.int64, len(flat))
        if new := self.known.new:
            self.known.new = []
            plain = np.fromiter((_WORD.fullmatch(w) is not None for w in new), bool, len(new))
            size, first = np.zeros(len(new), np.int64), np.zeros(len(new), np.int64)
            for chosen, ask in ((plain, self._word_ids), (~plain, self._ids)):
                size[chosen], ids = ask(list(compress(new, chosen)))
                first[chosen] = len(self.flat) + np.cumsum(size[chosen]) - size[chosen]
                self.flat = np.concatenate((self.flat, ids))
            self.first = np.concatenate((self.first, first))
            self.size = np.concatenate((self.size, size))
        size = self.size[which]
        ends = np.cumsum(size)
        source = np.repeat(self.first[which] - ends + size, size)
        source += np.arange(len(source))
        doc_ends = ends[np.flatnonzero(which == 0)]
        return np.diff(doc_ends, prepend=0).tolist(), self.flat[source]


@functools.lru_cache(maxsize=2)
def _encoder(path: str, end_id: int) -> LibraryEncoder:
    """One encoder for all tasks of a worker process: what it has learned stays."""
    return LibraryEncoder(path, end_id)


def write_texts(
    docs: DataFrame,
    folder: str,
    path: str,
    end_id: int,
    kind: str = "bit",
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Encode texts and write them below ``folder``; one row per file comes back.

    Rows are placed by ranges of the id (and a hash of the text for a repeated id), sorted
    within a task, and each task streams its part into one file.  A file is written under
    a name of its own and renamed when complete, so a repeated task replaces its file.
    """
    small_batches(docs.sparkSession)
    places, inner = fs.FileSystem.from_uri(folder)
    places.create_dir(inner, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        writer, encoder = None, None
        number = TaskContext.get().partitionId()
        name = f"{base}/ids-{number:06d}.bpl"
        own = f"{base}/_{number:06d}-{uuid.uuid4().hex}"
        for batch in batches:
            ids = batch.column(0).to_pylist()
            texts = batch.column(1).fill_null("").cast(pa.large_binary()).to_pylist()
            if writer is None and ids:
                writer = PlaneWriter(store.open_output_stream(own), kind)
                encoder = _encoder(path, end_id)
            i = 0
            while i < len(ids):
                j, size = i, 0
                while j < len(ids) and size <= BLOCK_BYTES:
                    size += len(texts[j])
                    j += 1
                counts, flat = encoder.encode(texts[i:j])
                writer.add(ids[i:j], counts, flat)
                i = j
        if writer is not None:
            writer.close()
            store.move(own, name)
            row = {"number": [number], "path": [name], "n_docs": [len(writer.docs[0])]}
            yield pa.RecordBatch.from_pydict({**row, "n_ids": [writer.n_ids]})

    placed = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")
    ).withColumn("_content", F.xxhash64("text"))
    placed = placed.repartitionByRange("doc_id", "_content")
    placed = placed.sortWithinPartitions("doc_id", "_content").select("doc_id", "text")
    files = placed.mapInArrow(write, "number long, path string, n_docs long, n_ids long")
    return staged(files, "id-files")


def read_documents(files: DataFrame, folder: str, digest: bool = False) -> DataFrame:
    """Documents of written files: ``doc_id, start, n_tokens`` and the ids or their crc32.

    ``start`` counts the ids of all documents before, over all files in order.  Only the
    list of files, one row per written partition, passes through the driver.
    """
    spark, start, rows = files.sparkSession, 0, []
    for f in files.orderBy("number").toLocalIterator():
        rows.append((f.path, start))
        start += f.n_ids
    schema = "doc_id long, start long, n_tokens long, "
    schema += "ids_crc32 long" if digest else "ids array<int>"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(folder)
        kind = pa.int64() if digest else pa.list_(pa.int32())
        for batch in batches:
            for path, base in zip(*(c.to_pylist() for c in batch.columns)):
                with store.open_input_file(path) as file:
                    reader = PlaneReader(file)
                    out: list[list] = [[], [], [], []]
                    for number, first, ids in reader.documents():
                        value = zlib.crc32(ids.astype("<u4").tobytes()) if digest else ids
                        row = (reader.doc_ids[number], base + first, len(ids), value)
                        for column, x in zip(out, row):
                            column.append(x)
                        if len(out[0]) == 512:
                            yield _batch(out, schema, kind)
                            out = [[], [], [], []]
                    yield _batch(out, schema, kind)

    listed = spark.createDataFrame(rows, "path string, start long")
    return listed.repartition(max(1, len(rows))).mapInArrow(read, schema)


def _batch(columns: list[list], schema: str, last: pa.DataType) -> pa.RecordBatch:
    names = [part.split()[0] for part in schema.split(", ")]
    kinds = [pa.int64()] * 3 + [last]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)
