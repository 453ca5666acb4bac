"""Class bigrams: counts against brute force, and properties of the model."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stormgauge.llm import brown
from stormgauge.llm.queries import QUERIES

MIDDLE = "/root/testdata/sf0.01"


def tokens(text):
    return [*(text or "").encode().lower().split(), None]


def expected(rows, held):
    counts = Counter(t for d, x in rows if not held(d) for t in tokens(x))
    n, v = sum(counts.values()), len(counts)
    return sorted(
        (
            (d, held(d), len(tokens(x)), sum(t in counts for t in tokens(x)), n,
             round(sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in tokens(x)), 5))
            for d, x in rows
        ),
        key=str,
    )


def shown(frame):
    return sorted(
        ((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in frame.collect()),
        key=str,
    )


def test_counts_and_perplexity_of_the_query(spark):
    rows = spark.read.parquet(f"{MIDDLE}/documents.parquet").select("doc_id", "text").collect()
    made = QUERIES["op6_brown_class_scores"](spark, MIDDLE).cache()
    assert shown(made) == expected(rows, lambda d: zlib.crc32(str(d).encode()) % 5 == 1)
    total = made.where("held_out").agg(F.sum("base_score"), F.sum("score")).first()
    assert total[1] > 0.95 * total[0] and total[1] < 0  # log probabilities: higher is better


def test_nulls_repeats_and_long_texts(spark):
    long = "One two  three " * 50_000
    rows = [(1, None), (2, ""), (2, ""), (3, "A a\tB"), (None, "b c"), (4, long), (10, "zzz One")]
    frame = spark.createDataFrame([(*r, 0.0) for r in rows], "doc_id long, text string, score double")
    made = brown.class_scores(frame, F.col("doc_id") == 10)
    assert shown(made) == expected(rows, lambda d: d == 10)
    assert all(np.isfinite(r.score) and r.score <= 0 for r in made.collect())


@pytest.mark.parametrize("held", ["true", "false"])
def test_no_training_rows_and_no_rows(spark, held):
    frame = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    made = brown.class_scores(frame, F.expr(held)).collect()
    assert len(made) == 2 and all(np.isfinite(r.score) for r in made)
    assert brown.class_scores(frame.where("false"), F.expr(held)).count() == 0


def test_probabilities_sum_to_one():
    n = np.array([5, 3, 2, 2, 1, 1, 1, 0])
    of = np.array([0, 0, 1, 1, brown.ONCE, brown.ONCE, brown.ONCE, brown.ONCE])
    total = np.zeros(brown.ALL)
    total[:2], total[brown.ONCE], total[brown.END] = (8, 4), 3, 0
    model = brown.ClassModel(20, 8, 5, 3, 2, total)
    emitted = 10 ** model.emission(n, of)
    for k in (0, 1, brown.ONCE):
        assert math.isclose(emitted[of == k].sum(), 1)
    counts = np.random.default_rng(1).integers(0, 9, (brown.ALL, brown.ALL)).astype(float)
    assert np.allclose((10 ** model.with_transitions(counts).transitions).sum(axis=1), 1)


def likelihood(bigrams, of, classes):
    member = np.zeros((len(bigrams), classes + 2))
    member[np.arange(len(bigrams)), [*of, classes, classes + 1]] = 1
    t = member.T @ bigrams @ member
    f = brown._xlogx
    return f(t).sum() - f(t.sum(axis=0)).sum() - f(t.sum(axis=1)).sum()


def test_exchange_separates_alternating_words():
    # words of two kinds that only follow the other kind
    bigrams = np.zeros((12, 12))
    rng = np.random.default_rng(2)
    for i in range(10):
        for j in range(10):
            if i % 2 != j % 2:
                bigrams[i, j] = rng.integers(5, 50)
    of = brown.exchange(bigrams, classes=2)
    assert len(set(of[::2])) == 1 and len(set(of[1::2])) == 1 and of[0] != of[1]
    start = np.arange(10) // 5
    assert likelihood(bigrams, of, 2) > likelihood(bigrams, start, 2)


def test_every_repeated_word_informs_its_neighbours(spark, monkeypatch):
    # four words of the core, and eight outside it whose only neighbours are each other
    rng = np.random.default_rng(3)
    rows = [("the cat the cat a dog a dog " * 50,)]
    for _ in range(60):
        rows.append((" ".join(f"{'xy'[k % 2]}{rng.integers(4)}" for k in range(10)),))
    monkeypatch.setattr(brown, "CORE", 4)
    frame = spark.createDataFrame([(i, False, t) for i, (t,) in enumerate(rows)], "doc_id long, held_out boolean, text string")
    coded = brown._coded(frame)
    found = brown.class_vocabulary(frame.select("text"), coded).collect()
    words = {w: h for t in rows for w, h in zip(t[0].split(), hashes(t[0]))}
    of = {r.word: r["class"] for r in found}
    x, y = ({of[words[f"{c}{k}"]] for k in range(4)} for c in "xy")
    assert not x & y and brown.ONCE not in x | y


def hashes(text):
    import pyarrow as pa

    return [h for _, _, w in brown.chunks(pa.array([text])) for h in w.hash.view(np.int64).tolist()]


def test_contexts_and_counts_of_a_block_agree(spark, monkeypatch):
    frame = spark.createDataFrame(
        [(i, False, t) for i, t in enumerate(["a b a c", "", "b a", "c c a b a"])], "doc_id long, held_out boolean, text string"
    ).coalesce(1)
    seen = []
    for often in (0, 1000):
        monkeypatch.setattr(brown, "OFTEN", often)
        coded = brown._coded(frame)
        state = coded.where("word is not null").selectExpr(
            "block", "local", "word", "cast(local % 2 as long) as class", "true as turn"
        )
        block = coded.where("word is not null").first().block
        texts = coded.where(f"ids is not null and block = {block}").select("block", "ids").toArrow()
        made = brown._block_contexts(texts, state.where(f"block = {block}").toArrow())
        pairs = made.filter(made["word"].is_null())
        table = np.zeros(brown.ALL**2)
        table[pairs["pair"].to_numpy()] = pairs["n"].to_numpy()
        sides, both = brown._gains(table.reshape(brown.ALL, brown.ALL))
        rest = made.filter(made["word"].is_valid()).combine_chunks()
        total = brown._summed(sides, both, *(rest[c].combine_chunks() for c in ("contexts", "counts")))
        seen.append((rest["local"].to_pylist(), total.tolist(), int(table.sum())))
    assert seen[0] == seen[1]


def test_words_travel_by_part_and_parts_decide_nothing(spark, monkeypatch):
    draw = np.random.default_rng(9)
    texts = [" ".join(f"w{k}" for k in draw.zipf(1.4, 40) % 300) for _ in range(80)]
    frame = spark.createDataFrame([(i, i % 5 == 0, t) for i, t in enumerate(texts)], "doc_id long, held_out boolean, text string")
    monkeypatch.setattr(brown, "CORE", 20)
    coded = brown._coded(frame.repartition(3))
    training, found = frame.where("not held_out").select("text"), []
    for part_words, step_rows in ((1 << 19, 2000), (60, 7)):
        monkeypatch.setattr(brown, "PART_WORDS", part_words)
        monkeypatch.setattr(brown, "STEP_ROWS", step_rows)
        made = brown.block_classes(training, coded)
        parts = max(1, -(-coded.where("word is not null").count() // part_words))
        assert made.count() <= parts * coded.select("block").distinct().count()
        found.append(sorted(tuple(r) for r in brown.words_of_blocks(made).collect()))
    assert found[0] == found[1] and len({r[2] for r in found[0]}) > 2


def test_turns_are_those_of_spark(spark):
    rows = spark.range(200).select(F.xxhash64("id").alias("w"))
    for number in (1, 2, 9):
        turn = F.pmod(F.xxhash64("w", F.lit(number)), F.lit(2)) == 0
        got = rows.select("w", turn.alias("t")).toArrow()
        assert (brown._turn(got["w"].to_numpy(), number) == got["t"].to_numpy()).all()
    assert brown._turn(got["w"].to_numpy(), 0).all()


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_a_pass_shuffles_no_texts(spark):
    rows = [(i, i % 3 == 0, f"a b{i} c a") for i in range(50)]
    frame = spark.createDataFrame(rows, "doc_id long, held_out boolean, text string").repartition(3)
    coded = brown._coded(frame)
    texts = coded.where("ids is not null and not held_out").select("block", "ids")
    assert "Exchange" not in plan(texts.groupBy("block").count())
    words = spark.createDataFrame([(0, b"")], "block long, words binary")
    both = texts.groupBy("block").cogroup(words.groupBy("block"))
    made = both.applyInArrow(lambda t, w: t.select(["block"]), "block long")
    assert plan(made).count("Exchange hashpartitioning") == 1
    # a row for all training texts of a block and one for those held out
    blocks = coded.select("block").distinct().count()
    assert coded.where("ids is not null").count() <= 2 * blocks
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("staged_")]


def test_gains_of_runs_are_those_of_their_rows():
    draw = np.random.default_rng(5)
    sides, pairs = brown._gains(draw.integers(0, 50, (brown.ALL, brown.ALL)).astype(float))
    contexts, counts, expected = [], [], []
    for n in (1, brown.SELDOM, brown.SELDOM + 1, 40, 2, 300):
        code = draw.integers(0, brown.ALL**2, n)
        met = [np.bincount(x, minlength=brown.ALL) for x in np.divmod(code, brown.ALL)]
        dense = n in (2, 300)
        contexts.append(None if dense else code.astype(np.uint16).tobytes())
        counts.append(np.concatenate(met).astype(np.int32).tobytes() if dense else None)
        expected.append(pairs[code].sum(axis=0, dtype=np.int64))
    columns = pa.array(contexts, pa.binary()), pa.array(counts, pa.binary())
    assert (brown._summed(sides, pairs, *columns) == expected).all()
    for begin in ([0], [0, 1, 4], [0, 3, 5]):
        runs = np.add.reduceat(expected, begin, axis=0)
        assert (brown._summed(sides, pairs, *columns, np.array(begin)) == runs).all()
