"""Bit-plane files: exact round trips, and the query against the library."""

import zlib

import numpy as np
import pytest
from pyarrow import fs
from tokenizers import Tokenizer

from stormgauge.llm import idfiles
from stormgauge.llm.queries import END_ID, QUERIES, WORD_VOCABULARY

SMALL = "/root/testdata/sf0.001"
LIBRARY = Tokenizer.from_file(WORD_VOCABULARY)


def with_end(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, END_ID]


@pytest.mark.parametrize("kind", ["bit", "byte"])
@pytest.mark.parametrize("n", [0, 1, 7, 8, 1000])
def test_planes_round_trip(kind, n):
    for top in (1, 2, 300, 49_408, 2**32 - 1):
        ids = np.random.default_rng(n).integers(0, top, n, dtype=np.uint64).astype(np.uint32)
        planes = idfiles.to_planes(ids, kind)
        assert (idfiles.from_planes(planes, n, kind) == ids).all()


@pytest.mark.parametrize("kind", ["bit", "byte"])
def test_any_range_is_read_through_the_index(tmp_path, kind):
    store = fs.LocalFileSystem()
    path = str(tmp_path / "x.bpl")
    ids = np.random.default_rng(1).integers(0, 49_408, 1000).astype(np.uint32)
    writer = idfiles.PlaneWriter(store.open_output_stream(path), kind, chunk_ids=64)
    counts = [0, 1, 400, 99, 500, 0]
    writer.add([None, 1, 2], counts[:3], ids[:401])
    writer.add([3, 4, 5], counts[3:], ids[401:])
    writer.close()
    with store.open_input_file(path) as file:
        reader = idfiles.PlaneReader(file)
        assert len(reader.index) == 16 and reader.counts == counts
        for a, b in [(0, 1000), (63, 65), (64, 128), (999, 1000), (5, 5), (200, 777)]:
            assert (reader.ids(a, b) == ids[a:b]).all()
        found = list(reader.documents())
        assert [len(f[2]) for f in found] == counts
        assert (np.concatenate([f[2] for f in found]) == ids).all()
    with pytest.raises(ValueError):
        (tmp_path / "y").write_bytes(b"x" * 40)
        idfiles.PlaneReader(store.open_input_file(str(tmp_path / "y")))


def test_query_equals_the_library_on_the_whole_table(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    want, start = [], 0
    for r in sorted(rows):
        ids = with_end(r.text)
        raw = np.array(ids, "<u4").tobytes()
        want.append((r.doc_id, start, len(ids), zlib.crc32(raw)))
        start += len(ids)
    got = QUERIES["op8_bit_plane_files"](spark, SMALL).collect()
    assert sorted(tuple(r) for r in got) == want


def test_nulls_repeats_and_long_texts(spark, tmp_path):
    rows = [(3, "Hi, you. <|endoftext|> x"), (1, None), (1, None), (None, "b!"), (2, ""), (9, "wörd, " * 60_000)]
    rows += [(4, "A<|ENDOFTEXT|>"), (5, "don't STOP, now... \x1c")]
    frame = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, start long")
    folder = str(tmp_path / "ids")
    files = idfiles.write_texts(frame, folder, WORD_VOCABULARY, END_ID)
    got = idfiles.read_documents(files, folder).orderBy("start").collect()
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r.doc_id for r in got] == [r[0] for r in ordered]
    assert [r.ids for r in got] == [with_end(r[1]) for r in ordered]
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1].tolist()]
    none = idfiles.write_texts(frame.where("false"), str(tmp_path / "no"), WORD_VOCABULARY, END_ID)
    assert idfiles.read_documents(none, str(tmp_path / "no")).count() == 0


def test_parts_of_texts_equal_the_library_and_words_skip_its_splitting():
    signs = "a B é É ß × ÷ ' 's ! % 5 ½ ñ ÿ Ÿ İ ı ll ́ ̸ < <|endoftext|> <| ª … 中 ſ À ~ _".split(" ")
    draw = np.random.default_rng(5)
    texts = ["".join(draw.choice([*signs, " ", "\n"], draw.integers(0, 15))) for _ in range(5000)]
    encoder = idfiles.LibraryEncoder(WORD_VOCABULARY, END_ID)
    counts, ids = encoder.encode([t.encode() for t in texts])
    ends = np.cumsum(counts)
    for text, n, end in zip(texts, counts, ends):
        assert ids[end - n : end].tolist() == with_end(text), text
    # the slow steps of the library see no part that is one plain word
    asked, ask = [], encoder._ids
    encoder._ids = lambda parts: asked.extend(parts) or ask(parts)
    words = ["Überraschung", "naïveté", "plainly!!", "x" * 200, "42", "it's"]
    counts, ids = encoder.encode([" ".join(words).encode()])
    assert ids.tolist() == with_end(" ".join(words)) and counts == [len(ids)]
    assert set(asked) <= {b"!!", b"42", b"it's"}
