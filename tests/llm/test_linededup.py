"""Line dedup and its perfect hash against brute force."""

import random

import numpy as np
import pytest

from stormgauge.llm import linededup

WHITE = " \t\n\v\f\r"
A_TO_Z = {c: c + 32 for c in range(65, 91)}


def brute(rows, least_chars=40, least_docs=5):
    held = {}
    for n, (doc_id, text) in enumerate(rows):
        for line in (text or "").split("\n"):
            key = line.strip(WHITE).translate(A_TO_Z)
            if len(key) >= least_chars:
                held.setdefault(key, {})[n] = -(2**63) if doc_id is None else doc_id
    keeper = {k: max(v.values()) for k, v in held.items() if len(v) >= least_docs}
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        own = -(2**63) if doc_id is None else doc_id
        kept = [x for x in lines if keeper.get(x.strip(WHITE).translate(A_TO_Z), own) == own]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def found(frame, **parameters):
    made = linededup.drop_shared_lines(frame, **parameters)
    return sorted(
        ((r.row.doc_id, r.n_lines, r.n_dropped, r.kept) for r in made.collect()), key=str
    )


def corpus(seed, n=120):
    rng = random.Random(seed)
    shared = ["".join(rng.choice("abÀÉ çxyz") for _ in range(rng.randint(36, 60))) for _ in range(15)]
    rows = []
    for i in range(n):
        lines = []
        for _ in range(rng.randint(0, 6)):
            line = rng.choice(shared) if rng.random() < 0.6 else f"own {i} " + "x" * rng.randint(0, 50)
            lines.append(rng.choice(["", " ", "\t\v", " "]) + rng.choice([line, line.upper()]) + rng.choice(["", "\r", "  "]))
        rows.append((i, "\n".join(lines)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(linededup, "FOLD", 10)
    rows = corpus(seed)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert found(frame) == brute(rows)
    assert any(n for _, _, n, _ in brute(rows))


def test_other_bounds(spark):
    rows = corpus(3)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert found(frame, least_chars=45, least_docs=3) == brute(rows, 45, 3)


def test_nulls_repeats_ties_and_long_texts(spark):
    line = "the same long line of boilerplate in all of these documents"
    long = "\n".join(f"{k} " + line for k in range(3000)) + "\n" + line + "\n"
    rows = [(None, line), (None, None), (1, ""), (2, line), (2, line), (3, "\n" + line + "\n\n"), (4, long), (4, line)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(frame) == brute(rows)


def test_rows_without_id_alone_keep_their_line(spark):
    line = "the same long line of boilerplate in all of these documents"
    rows = [(None, line)] * 6
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_clashing_names_and_empty_tables(spark):
    names = "doc_id long, text string, row long, id long, content long, dropped string, n_lines long, kept long"
    frame = spark.createDataFrame([(1, "a\nb", 2, 3, 4, "5", 6, 7)], names)
    made = linededup.drop_shared_lines(frame).first()
    assert (made.row.kept, made.n_lines, made.kept) == (7, 2, "a\nb")
    assert found(frame.limit(0)) == []


def test_perfect_hash_numbers_each_key_once():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 1000, 50_000):
        keys = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2))
        index = linededup.PerfectHash.of(keys)
        assert sorted(index(keys).tolist()) == list(range(len(keys)))
        others = keys + np.uint64(1)
        assert (index(others) < 0).mean() > 0.999 if n else len(index(others)) == 0
        assert len(index.bits) * 64 <= max(64 * 12, 5 * len(keys))
