"""The convolutional classifier: learned cues, held-out accuracy and special cases."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stormgauge.llm import common, langid, toxicity
from stormgauge.llm.queries import QUERIES
from stormgauge.llm.words import chunks

WORDS = [a + b + c for a in ("ka", "lo", "mi", "su") for b in ("ren", "tov", "pil") for c in ("a", "el", "is")]


def texts(seed, n):
    rng = random.Random(seed)
    out, toxic = [], []
    for i in range(n):
        words = rng.choices(WORDS, k=rng.randint(5, 120))
        toxic.append(int(rng.random() < 0.3))
        if toxic[-1]:
            for _ in range(rng.randint(1, 3)):
                words[rng.randrange(len(words))] = rng.choice(["grumph", "Zlork"]) + rng.choice(WORDS)
        out.append(" ".join(words))
    return out, toxic


@pytest.fixture(scope="module")
def model():
    words, toxic = texts(1, 700)
    return toxicity.train(words, toxic, [""] * len(words))


def scores(model, words):
    out = []
    for _, count, found in chunks(pa.array(words, pa.string())):
        marked = langid.distinct_grams(found, toxicity.SIZES)
        out.append(model.score(model.logits(found, marked), [""] * count))
    return np.concatenate(out)


def test_stems_are_found_in_new_texts(model):
    words, toxic = texts(2, 300)
    assert ((scores(model, words) >= 0.5) == np.array(toxic)).mean() > 0.97


def test_a_cue_counts_wherever_it_stands(model):
    clean = " ".join(WORDS * 900)
    found = scores(model, [clean, clean + " grumphloren", "grumphloren " + clean, "", "   "])
    assert (found >= 0.5).tolist() == [False, True, True, False, False]
    assert found[3] == found[4]


def test_pooling_equals_windows_one_by_one(model):
    words = ["", "a", "a b", "a b c a", "b"]
    for _, _, found in chunks(pa.array(words, pa.string())):
        inverse, buckets, first = langid.distinct_grams(found, toxicity.SIZES)
        vectors = toxicity._vectors(model.embedding, found, inverse, buckets, first)
        got = model.pooled(vectors, inverse, found.first)
        for k in range(len(words)):
            own = [vectors[i] for i in inverse[found.first[k] : found.first[k + 1]]]
            padded, want = [*own, *[np.zeros(toxicity.DIMENSIONS)] * 3], []
            for width, f in model.filters.items():
                at = [sum(padded[i + s] @ f[s] for s in range(width)) for i in range(len(own))]
                top = np.max(at, axis=0) + model.bias[width] if own else np.zeros(f.shape[2])
                want.append(np.maximum(top, 0))
            assert np.allclose(got[k], np.concatenate(want), atol=1e-4)


def test_columns_and_empty_tables(spark, model):
    language = langid.LanguageModel([], np.zeros((1 << langid.BITS, 0), np.float32), np.zeros(0))
    rows = [(1, None), (2, ""), (2, ""), (3, "grumphloren " * 3), (None, "loren")]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, score int")
    made = frame.select(toxicity.rate(model, language, frame).alias("s")).collect()
    assert [r.s >= 0.5 for r in made] == [False, False, False, True, False]
    empty = frame.where("false")
    assert empty.select(toxicity.rate(model, language, empty)).count() == 0
    untrained = toxicity.train(["a"], [0], [""])
    assert frame.select(toxicity.rate(untrained, language, frame).alias("s")).first().s == 0


def test_query_on_held_out_rows(spark):
    sf_dir = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    rows = QUERIES["op4_convolutional_toxicity"](spark, sf_dir).where("held_out").join(labels, "doc_id")
    rows = rows.collect()
    found = sum(r.predicted for r in rows if r.toxic)
    assert found >= 0.7 * sum(r.toxic for r in rows)
    assert sum(r.predicted for r in rows if not r.toxic) <= 0.02 * len(rows)


def test_every_labelled_row_is_learned_from(spark, monkeypatch):
    """the model came from 2,500 rows of each class; here from all rows, in several shards."""
    words, toxic = texts(5, 6000)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(words)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, x) for i, x in enumerate(toxic)], "doc_id long, toxic int")
    language = langid.LanguageModel([], np.zeros((1 << langid.BITS, 0), np.float32), np.zeros(0))
    read, average = [], toxicity._average_model

    def counted(start, rows, counts):
        read.append((rows.count(), int(counts.sum()), rows.select("shard").distinct().count()))
        return average(start, rows, counts)

    monkeypatch.setattr(toxicity, "_average_model", counted)
    monkeypatch.setattr(common, "SHARD_BYTES", 500_000)
    made = toxicity.fit_toxicity_model(docs, labels, F.col("doc_id") >= 0, language)
    (fit, counted_rows, shards), = read
    # a fifth is held back for the thresholds
    assert fit == counted_rows and 4600 < fit < 5000 and shards >= 4
    fresh, want = texts(6, 300)
    assert ((scores(made, fresh) >= 0.5) == np.array(want)).mean() > 0.97
