"""The Jaccard join against brute force."""

import random
import re

import pytest

from stormgauge.llm import jaccard


def shingles(text, words=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return set()
    return {tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))}


def brute(rows, percent=80):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return sorted(
        ((d, len(s), least.get(root(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))),
        key=str,
    )


def found(spark, rows, extra=""):
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    out = jaccard.jaccard_components(frame).select("doc_id", "n_shingles", "component_id").collect()
    return sorted((tuple(r) for r in out), key=str)


def corpus(seed, n=160):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    passage = [rng.choice(vocabulary) for _ in range(30)]
    bases = [[rng.choice(vocabulary) for _ in range(rng.randint(1, 90))] for _ in range(12)]
    rows = []
    for i in range(n):
        w = list(rng.choice(bases))
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(w) + 1)
            w[at : at + rng.randint(0, 1)] = [rng.choice(vocabulary)] * rng.randint(0, 2)
        if rng.random() < 0.4:
            at = rng.randrange(len(w) + 1)
            w[at:at] = passage
        rows.append((i, " ".join(w)))
    return rows


@pytest.mark.parametrize("frequent", [2, 6, 1000])
@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, monkeypatch, seed, frequent):
    monkeypatch.setattr(jaccard, "FREQUENT", frequent)
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    rows = corpus(seed)
    assert found(spark, rows) == brute(rows)


def test_nulls_blanks_repeats_and_long_texts(spark):
    long = " ".join(f"x{i % 7919}" for i in range(60_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One two"), (5, "one  TWO"), (6, "one two three")]
    rows += [(7, long), (8, long + " end"), (None, "one two"), (9, "a b c d e f"), (9, "a b c d e f")]
    rows += [(0, "É é"), (10, "é é")]
    assert found(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert found(spark, []) == []


def test_parity_never_exceeds_the_difference():
    import numpy as np

    rng = np.random.default_rng(1)
    for _ in range(200):
        x = np.unique(rng.integers(0, 2**63, rng.integers(1, 900), dtype=np.uint64))
        y = np.unique(np.concatenate((x[rng.random(len(x)) < 0.8], x[:3] + np.uint64(1))))
        true = len(np.setxor1d(x, y))
        bitmaps = np.array([jaccard.parity(x), jaccard.parity(y)], object)
        least = jaccard.least_difference(*bitmaps)
        assert least <= true
        pair = jaccard.least_differences(bitmaps, np.array([0, 1]), np.array([1, 0]))
        assert pair.tolist() == [least, least]


def test_one_row_of_each_component_stays(spark):
    rows = corpus(4, 60) + [(0, corpus(4, 60)[0][1]), (None, "x y z"), (None, "X  y z"), (70, None), (70, None)]
    rows += [(71, "alpha beta"), (71, "gamma delta"), (71, "gamma delta"), (72, "gamma delta")]
    frame = spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, root string")
    kept = sorted(((r.doc_id, r.text) for r in jaccard.one_per_component(frame).collect()), key=str)
    components = {}
    for d, n, c in brute(rows[:60]):
        components.setdefault(c, []).append(d)
    expected = [(c, dict(rows[:60])[c]) for c in components if c is not None]
    assert [k for k in kept if k[0] is not None and k[0] < 60] == sorted(expected, key=str)
    assert [k[0] for k in kept].count(70) == 2
    assert sorted(k[1] for k in kept if k[0] == 71) == ["alpha beta", "gamma delta"]
    assert sum(k[0] is None for k in kept) == 1 and all(k[0] != 72 for k in kept)


def test_packed_counts_round_trip():
    import numpy as np

    values = np.random.default_rng(2).integers(0, 2**40, 5000, dtype=np.uint64)
    values = np.append(values, values[:700])
    parts, blocks = jaccard.pack_counts(values, 8)
    back = [jaccard.unpack_counts(b) + np.uint64(p << 32) for p, b in zip(parts, blocks)]
    assert (np.concatenate(back) == np.sort(values)).all()
