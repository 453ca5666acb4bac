"""Alignment of two tokenizers against brute force with the tokenizers' own libraries."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from stormgauge.llm import tokenalign

A = public_tokenizers.path("byte_bpe_50k.json")
B = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def spans(tokens):
    out, at = [], 0
    for t in tokens:
        out.append((at, at + len(t)))
        at += len(t)
    return out


def brute(library, rows):
    a, b = library
    to_byte = tokenalign.byte_characters()

    def piece(n):
        p = b.id_to_piece(n)
        return bytes([int(p[3:5], 16)]) if b.is_byte(n) else p.replace("▁", " ").encode()

    made, counts = [], Counter()
    for doc_id, text in rows:
        ids_a = a.encode(" " + (text or ""), add_special_tokens=False).ids
        ids_b = b.encode(text or "")
        x = [bytes(to_byte[c] for c in a.id_to_token(n)) for n in ids_a]
        y = [piece(n) for n in ids_b]
        whole = (" " + (text or "")).encode()
        if not text or b"".join(x) != whole or b"".join(y) != whole:
            made.append((doc_id, None, None, None))
            continue
        sa, sb = spans(x), spans(y)
        links = []
        for i, (s, e) in enumerate(sa):
            links += [(ids_a[i], ids_b[j]) for j, (u, v) in enumerate(sb) if s < v and u < e]
        ends = sorted({e for _, e in sa} & {e for _, e in sb})
        shown, low = [], 0
        for end in ends:
            left = ",".join(str(n) for n, (_, e) in zip(ids_a, sa) if low < e <= end)
            right = ",".join(str(n) for n, (_, e) in zip(ids_b, sb) if low < e <= end)
            shown.append(f"{left}|{right}")
            low = end
        counts.update(set(links))
        made.append((doc_id, (len(ids_a), len(ids_b), len(ends)), links, ";".join(shown)))
    best = Counter()
    for (i, _), n in counts.items():
        best[i] = max(best[i], n)
    out = []
    for doc_id, sizes, links, shown in made:
        if sizes is None:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_best = sum(counts[p] == best[p[0]] for p in links)
        digest = hashlib.sha256(shown.encode()).hexdigest()
        out.append((doc_id, *sizes, len(links), n_best, sum(counts[p] for p in links), digest))
    return sorted(out, key=str)


def found(frame):
    made = tokenalign.alignments(frame, A, B)
    made = made.select("row.doc_id", *tokenalign.MEASURES, "groups_sha256")
    return sorted((tuple(r) for r in made.collect()), key=str)


ODD = [
    None,
    "",
    " ",
    "\n",
    "▁",
    "a▁b",
    "<|endoftext|> <s> </s> <unk> <0x41>",
    "naïve Ünïcode 東京 😀👍🏽 é ​﻿  ",
    "  two  blanks\t\tand\ttabs \r\n\r\n",
    "1234567890 3.14 -- !!!??? don't WE'LL i'm",
    "\x00\x01\x7f \x80\x9f­",
]


def corpus(seed, n=80):
    rng = random.Random(seed)
    words = ["the", "Tokens", "übergroß", "naïve", "of", "1999", "x", "antidisestablishment", "東京", "\n", "--"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 60))) for _ in range(n // 3)]
    return [(i, rng.choice(texts[:3]) if rng.random() < 0.3 else rng.choice(texts)) for i in range(n)]


def test_equals_brute_force(spark, library, monkeypatch):
    monkeypatch.setattr(tokenalign, "CHUNK_BYTES", 500)
    monkeypatch.setattr(tokenalign, "BLOCK_LINKS", 100)
    monkeypatch.setattr(tokenalign, "FOLD", 50)
    rows = corpus(1) + [(1000 + k, t) for k, t in enumerate(ODD)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert found(frame) == brute(library, rows)


@pytest.mark.parametrize("hot", [1, 4, 10**9])
def test_hot_texts_change_nothing(spark, library, monkeypatch, hot):
    monkeypatch.setattr(tokenalign, "HOT", hot)
    rows = corpus(2)
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute(library, rows)


def test_ids_missing_rows_repeated_and_long_texts(spark, library):
    rows = [(None, "one text"), (None, None), (3, "one text"), (3, "one text"), (4, "long words " * 4000 + "z" * 3000)]
    got = found(spark.createDataFrame(rows, "doc_id long, text string"))
    assert [r[:4] for r in got] == [r[:4] for r in brute_short(library, rows)]


def brute_short(library, rows):
    """Counts of tokens alone; all pairs of a long text take too long."""
    a, b = library
    out = []
    for doc_id, text in rows:
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        to_byte = tokenalign.byte_characters()
        ends_a = {e for _, e in spans([bytes(to_byte[c] for c in a.id_to_token(n)) for n in ids_a])}
        pieces = [b.id_to_piece(n) for n in ids_b]
        ends_b = {e for _, e in spans([p.replace("▁", " ").encode() for p in pieces])}
        out.append((doc_id, len(ids_a), len(ids_b), len(ends_a & ends_b)))
    return sorted(out, key=str)


def test_empty_tables_and_clashing_names(spark, library):
    names = "doc_id long, text string, row long, name string, hot long, cold long, n_a string"
    frame = spark.createDataFrame([(1, "some text", 2, "3", 4, 5, "6")], names)
    made = tokenalign.alignments(frame, A, B).first()
    assert made.row.n_a == "6" and made.n_a == brute(library, [(1, "some text")])[0][1]
    assert found(frame.limit(0)) == []
    assert found(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")) == [
        (1, 0, 0, 0, 0, 0, 0, ""),
        (2, 0, 0, 0, 0, 0, 0, ""),
    ]


def test_ids_are_those_of_the_library(library):
    encoder, tokens = tokenalign.byte_level(A)
    characters = [chr(c) for c in range(0x20000) if not 0xD800 <= c < 0xE000]
    texts = [f" a{c}b 1{c}2 !{c}? {c} {c}{c}x" for c in characters]
    made = library[0].encode_batch_fast(texts, add_special_tokens=False)
    assert all(e.ids == ids for e, ids in zip(made, encoder.encode_ordinary_batch(texts)))
    assert len(tokens) == 50256
