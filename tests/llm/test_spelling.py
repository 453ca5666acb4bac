"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import pytest

from stormgauge.llm import spelling

A_TO_Z = {c: c + 32 for c in range(65, 91)}


def distance_is_one(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def words(rows, thin=31):
    total = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(A_TO_Z)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % thin == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            total[run] += 1
    return total


def brute(rows, least_chars=7, least_count=2, times=10):
    n = {w: c for w, c in words(rows).items() if len(w) >= least_chars and c >= least_count}
    near = {w: [v for v in n if distance_is_one(w, v)] for w in n}
    form = {}
    for w, others in near.items():
        if others:
            best = min(others, key=lambda v: (-n[v], v))
            form[w] = best if n[best] >= times * n[w] else None
    out = []
    for w in n:
        root = w
        while form.get(root):
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(near[w]), n.get(form.get(w))))
    return sorted(out)


def found(frame, **parameters):
    return sorted(tuple(r) for r in spelling.spelling_variants(frame, **parameters).collect())


def corpus(seed, n=60):
    rng = random.Random(seed)
    stems = ["".join(rng.choice("abeÀéñ×thon") for _ in range(rng.randint(5, 11))) for _ in range(25)]
    rows = []
    for i in range(n):
        text = []
        for _ in range(rng.randint(0, 60)):
            w = stems[min(int(rng.expovariate(0.2)), 24)]
            if rng.random() < 0.3:
                k = rng.randrange(len(w))
                w = w[:k] + rng.choice(["", "e", "ee", w[k].upper()]) + w[k + 1 :]
            text.append(w)
        rows.append((i, rng.choice([" ", "-", "1 "]).join(text)))
    return rows


@pytest.mark.parametrize("seed, part", [(1, 200_000), (2, 3), (3, 20)])
def test_equals_brute_force(spark, seed, part, monkeypatch):
    monkeypatch.setattr(spelling, "SEARCHING", 7)
    monkeypatch.setattr(spelling, "COUNTED", 20)
    rows = corpus(seed)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    counted = spelling.counted_words(frame, "doc_id", "text", 7).where("n >= 2")
    near = {r.word.decode("latin-1"): (r.n_near, r.best_n) for r in spelling.near_words(counted, part).collect()}
    expected = brute(rows)
    assert near.keys() == {w for w, *_, k, _ in expected if k}
    assert found(frame) == expected
    assert all(near[w][0] == k for w, _, _, _, k, _ in expected if k)
    assert sum(f is not None for _, f, *_ in expected) > 3


def test_forms_lead_on_and_ties_go_to_the_smaller_word(spark):
    words = ["abcdefgh"] * 2 + ["abcdefgx"] * 20 + ["abcdefgxy"] * 200 + ["abcdefgxyz"] * 2000
    words += ["mnopqrs"] * 2 + ["mnopqrt"] * 30 + ["mnopqra"] * 30
    rows = [(0, " ".join(words)), (None, None), (1, "")]
    made = {r[0]: r for r in brute(rows)}
    assert made["abcdefgh"][2] == "abcdefgxyz" and made["mnopqrs"][1] == "mnopqra"
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == sorted(made.values())


def test_very_long_runs_and_rows_without_id(spark):
    long = "ab" * 3000 + "c" * 20
    rows = [(None, f"{long} {long}c"), (None, f"{long} {long}c {long[:-1]}"), (5, long + "d")] * 2
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_empty_tables_and_clashing_names(spark):
    rows = [(1, "needless needless needles needles", "n", 3)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, word string, n long")
    assert found(frame) == brute([r[:2] for r in rows])
    assert found(frame.limit(0)) == []


def test_cells_cover_all_single_edits():
    rng = random.Random(5)
    letters = "etaoisnrhldcumfpgwybvkxjqzéÀÿ×"

    def cell(word):
        out = 0
        for k in range(spelling.PLACED):
            n = sum(spelling._GROUP[ord(c)] == k for c in word)
            out = out * (spelling.TOP + 1) + min(n, spelling.TOP)
        return out

    for _ in range(3000):
        w = "".join(rng.choice(letters[: rng.choice([3, 30])]) for _ in range(rng.choice([7, 60, 70])))
        k = rng.randrange(len(w))
        v = w[:k] + rng.choice(["", rng.choice(letters), rng.choice(letters) + w[k]]) + w[k + 1 :]
        low, high = sorted((cell(w), cell(v)))
        assert high in spelling.cells_searched(low)
