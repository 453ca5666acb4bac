"""Rank-array BPE against the tokenizers library."""

import hashlib
import random

import pytest
from tokenizers import Tokenizer

from stormgauge.llm import bpe
from stormgauge.llm.queries import QUERIES, WORD_VOCABULARY

SMALL = "/root/testdata/sf0.001"
LIBRARY = Tokenizer.from_file(WORD_VOCABULARY)
OWN = bpe.RankArrayBpe(WORD_VOCABULARY)


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def texts():
    rng = random.Random(3)
    letters = "aàbcdeé's 't\t\n\x1c\x85\xa0ΣσςİÉ́ <|endoftext|><|startoftext|>中123½!?.-_"
    out = ["", " \n", "<|ENDOFTEXT|>", "<|endoftext|>a<|startoftext|>", "İ Straße ﬁ", "don't we'll 's"]
    for _ in range(3000):
        out.append("".join(rng.choice([*letters, "<|endoftext|>"]) for _ in range(rng.randrange(30))))
    return out


def test_ids_and_decoded_text_equal_the_library():
    for text in texts():
        ids = library_ids(text)
        assert OWN.encode(text) == ids, text
        assert OWN.decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("n", [1, 2, 95, 96, 97, 400, 20_000])
def test_long_words(n):
    rng = random.Random(n)
    for alphabet in ("thereanoisdc", "aé", "=-"):
        text = "".join(rng.choice(alphabet) for _ in range(n))
        assert OWN.encode(text) == library_ids(text)


def test_query_equals_the_library_on_the_whole_table(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = []
    for r in rows:
        ids = library_ids(r.text)
        shown = LIBRARY.decode(ids, skip_special_tokens=False)
        digest = [hashlib.sha256(s.encode()).hexdigest() for s in (" ".join(map(str, ids)), shown)]
        want.append((r.doc_id, len(ids), *digest))
    got = QUERIES["op7_bpe_rank_array"](spark, SMALL).collect()
    assert sorted(tuple(r) for r in got) == sorted(want)


def test_columns_round_trip(spark):
    rows = [(1, None, 5), (1, None, 5), (2, "", 6), (3, "Hello, wörld " * 20_000, 7), (None, "a", 8)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, ids long")
    made = bpe.decoded(bpe.encoded(frame, WORD_VOCABULARY), WORD_VOCABULARY)
    assert made.columns == ["doc_id", "text", "ids", "decoded"]
    found = made.collect()
    assert len(found) == 5
    for r in found:
        assert r.ids == library_ids(r.text)
        assert r.decoded == LIBRARY.decode(r.ids, skip_special_tokens=False)
    assert bpe.encoded(frame.where("false"), WORD_VOCABULARY).count() == 0
