"""Language identification by averaged hashed subword embeddings and a linear softmax.

A text is the mean of the embeddings of the byte n-grams of its marked words; a linear
softmax over that mean gives the languages.  Both are trained by stochastic gradient
descent in numpy on all usable rows: one task trains on each shard of them, all from the same
start.  As the classifier is linear in the mean, embeddings and weights are multiplied after
training, the products of the shards are averaged, and predicting is one small table lookup
per n-gram.  A temperature makes scores probabilities, and a threshold, both set on rows that
were not trained on, rejects what is too uncertain.

Whole texts are predicted, whatever their length.  Null texts and texts without a letter
are ``und`` with score 0 and rejected; so is everything if there is no labelled row.  Only
the text is looked at, so repeated rows and ties in it get the same answer; ties between
languages go to the first in alphabetical order.  Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stormgauge.llm.common import PARTS_SCHEMA, averaged, discard, sliced, small_batches, staged, training_rows
from stormgauge.llm.words import Words, chunks, grams

UNDETERMINED = "und"
SIZES = (2, 3, 4)
BITS = 16
DIMENSIONS = 16
# most labels a model may have
MOST_LABELS = 24_000
# a shard goes over its rows until it has made about so many steps, once at least, EPOCHS times at most
STEPS = 9_000
EPOCHS = 6
# steps of the score when thresholds are set
BINS = 10_000
# share of accepted rows that may be wrong, and the least score ever asked for
ACCEPTED_ERROR = 0.01
LEAST_SCORE = 0.4
TEMPERATURES = np.geomspace(0.05, 20, 60)
_HAS_LETTER = regex.compile(r"\p{L}")


@dataclass
class LanguageModel:
    languages: list[str]
    scores: np.ndarray  # n-gram bucket x language, already through the linear layer
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = LEAST_SCORE

    def logits(self, words: Words, marked=None) -> np.ndarray:
        """Logits of each text of a chunk; ``marked`` is what ``distinct_grams`` gave."""
        k = len(self.languages)
        inverse, buckets, first = marked or distinct_grams(words)
        padded = np.zeros((len(self.scores) + 1, k + 1), np.float32)
        padded[:-1, :k], padded[:-1, k] = self.scores, 1
        sums = np.zeros((buckets.shape[1], k + 1), np.float32)
        for row in buckets[: len(SIZES)]:
            sums += padded[row]
        word = np.add.reduceat(sums, first[:-1], axis=0) if len(sums) else sums
        total = np.concatenate((np.zeros((1, k + 1)), np.cumsum(word[inverse], 0, np.float64)))
        edge = words.first
        text = total[edge[1:]] - total[edge[:-1]]
        return text[:, :k] / np.maximum(text[:, k:], 1) + self.bias

    def predict(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Index of the language of each text (-1: undetermined) and its score."""
        best, score = np.full(len(column), -1), np.zeros(len(column))
        if self.languages:
            for row, count, words in chunks(column):
                best[row : row + count], score[row : row + count] = self.choose(self.logits(words))
        letters = [bool(t and _HAS_LETTER.search(t)) for t in column.to_pylist()]
        best[~np.array(letters, bool)] = -1
        score[best < 0] = 0
        return best, score

    def choose(self, logits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p = _softmax(logits / self.temperature)
        best = p.argmax(axis=1)
        return best, p[np.arange(len(p)), best]


def distinct_grams(words: Words, sizes: tuple[int, ...] = SIZES):
    """N-gram buckets of the distinct words of a chunk; ``1 << BITS`` where none begins."""
    _, at, inverse = np.unique(words.hash, return_index=True, return_inverse=True)
    buckets, valid, first = grams(words, at, sizes, BITS)
    buckets[~valid] = 1 << BITS
    return inverse, buckets, first


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _features(texts: pa.ChunkedArray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Distinct n-gram buckets of each text and their shares."""
    out = []
    for _, count, words in chunks(texts):
        inverse, buckets, first = distinct_grams(words)
        by_place = buckets.T
        valid = by_place < 1 << BITS
        flat = by_place[valid].astype(np.uint16)
        length = np.add.reduceat(valid.sum(axis=1), first[:-1]) if len(first) > 1 else first[:0]
        begin, edge = np.cumsum(length) - length, words.first
        for k in range(count):
            word = inverse[edge[k] : edge[k + 1]]
            size = length[word]
            # 16-bit numbers are sorted by radix
            found = np.sort(flat[np.repeat(begin[word], size) + _ranges(size)], kind="stable")
            at = np.flatnonzero(np.concatenate(([len(found) > 0], found[1:] != found[:-1])))
            n = np.diff(at, append=len(found))
            out.append((found[at], (n / max(len(found), 1)).astype(np.float32)))
    return out


def _ranges(sizes: np.ndarray) -> np.ndarray:
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - sizes, sizes)


def train(texts, labels: list[str], epochs: int = 6, rate: float = 0.5, seed: int = 7):
    """Fit a model to labelled texts (a list or an Arrow column); a fifth only calibrates it."""
    if isinstance(texts, list):
        texts = pa.array(texts, pa.string())
    languages = sorted(set(labels))
    k = len(languages)
    rng = np.random.default_rng(seed)
    if not k:
        return LanguageModel([], np.zeros((1 << BITS, 0), np.float32), np.zeros(0))
    n_texts, features = len(texts), _features(texts)
    del texts
    target = np.array([languages.index(x) for x in labels])
    order = rng.permutation(n_texts)
    held = order[: len(order) // 5]
    fit = order[len(order) // 5 :]
    scores, bias = _descend(features, target, fit, k, epochs, rate, rng)
    model = LanguageModel(languages, scores, bias.astype(np.float64))
    held = held if len(held) else fit
    logits = np.array([features[i][1] @ model.scores[features[i][0]] + bias for i in held])
    _calibrate(model, logits, target[held])
    return model


def _descend(features, target, fit, k: int, epochs: int, rate: float, rng) -> tuple[np.ndarray, np.ndarray]:
    """Scores of the n-gram buckets and biases after ``epochs`` passes over the rows ``fit``."""
    embedding = rng.normal(0, 0.1, (1 << BITS, DIMENSIONS)).astype(np.float32)
    weights = rng.normal(0, 0.1, (DIMENSIONS, k)).astype(np.float32)
    bias = np.zeros(k, np.float32)
    step, steps = 0, max(1, epochs * len(fit))
    for _ in range(epochs):
        for i in rng.permutation(fit):
            bucket, share = features[i]
            rows = embedding[bucket]
            mean = share @ rows
            error = _softmax(mean @ weights + bias)
            error[target[i]] -= 1
            now = rate * (1 - step / steps)
            back = weights @ error
            weights -= now * np.outer(mean, error)
            bias -= now * error
            # every n-gram of the text takes part in its share, scaled to a useful step
            rows -= (now * 40 * share)[:, None] * back
            embedding[bucket] = rows
            step += 1
    return embedding @ weights, bias


def _calibrate(model: LanguageModel, logits: np.ndarray, target: np.ndarray) -> None:
    row = np.arange(len(target))

    def loss(temperature):
        return -np.log(_softmax(logits / temperature)[row, target] + 1e-12).mean()

    model.temperature = float(min(TEMPERATURES, key=loss))
    best, score = model.choose(logits)
    order = np.argsort(-score)
    _set_threshold(model, score[order], np.ones(len(row)), best[order] != target[order])


def _set_threshold(model: LanguageModel, score: np.ndarray, n: np.ndarray, wrong: np.ndarray) -> None:
    """From falling scores, how often each occurs and how often it is wrong."""
    share = np.cumsum(wrong) / np.cumsum(n)
    fine = np.flatnonzero(share <= ACCEPTED_ERROR)
    asked = score[fine[-1]] if len(fine) and fine[-1] < len(score) - 1 else 0.0
    model.threshold = float(max(LEAST_SCORE, min(asked, 0.9)))


def fit_language_model(
    docs: DataFrame, usable: Column, doc_id: str = "doc_id", text: str = "text", lang: str = "lang"
) -> LanguageModel:
    """Model learned from all rows where ``usable`` holds and the language is not null."""
    small_batches(docs.sparkSession)
    rows = docs.where(usable).select(
        F.col(doc_id).alias("doc_id"),
        F.col(lang).cast("string").alias("label"),
        F.col(text).alias("text"),
        F.octet_length(text).alias("bytes"),
    )
    rows = training_rows(rows)
    counts = rows.groupBy("label").agg(F.count_if("held").alias("held"), F.count_if(~F.col("held")).alias("fit"))
    counts = staged(counts.limit(MOST_LABELS + 1), "labels").collect()
    if len(counts) > MOST_LABELS:
        raise ValueError(f"more than {MOST_LABELS} labels")
    languages = sorted(r.label for r in counts)
    if not languages:
        return train([], [])
    fit = rows.where("not held") if any(r.fit for r in counts) else rows
    model = _average_model(fit, languages)
    _calibrate_all(model, rows.where("held") if any(r.held for r in counts) else rows)
    return model


def _average_model(rows: DataFrame, languages: list[str], rate: float = 0.5, seed: int = 7) -> LanguageModel:
    number = {x: i for i, x in enumerate(languages)}
    k = len(languages)

    def part(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("label", "ascending")])
        target = np.array([number[x] for x in table["label"].to_pylist()])
        shard, n, features = table["shard"][0].as_py(), table.num_rows, _features(table["text"])
        epochs = int(np.clip(np.rint(STEPS / n), 1, EPOCHS))
        rng = np.random.default_rng(seed)
        scores, bias = _descend(features, target, np.arange(n), k, epochs, rate, rng)
        return sliced(shard, n, np.concatenate((scores.ravel(), bias)))

    vector = averaged(rows.drop("held").groupBy("shard").applyInArrow(part, PARTS_SCHEMA))
    return LanguageModel(languages, vector[:-k].reshape(1 << BITS, k).copy(), vector[-k:].astype(np.float64))


def _calibrate_all(model: LanguageModel, rows: DataFrame) -> None:
    """As ``_calibrate``, by sums over the rows of a table."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(model)
    number = {x: i for i, x in enumerate(model.languages)}

    def logits_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            target = np.array([number[x] for x in batch.column(0).to_pylist()])
            for row, count, words in chunks(batch.column(1)):
                logits = shared.value.logits(words)
                yield pa.RecordBatch.from_pydict(
                    {"target": target[row : row + count], "logits": pa.array(list(logits), pa.list_(pa.float64()))}
                )

    held = staged(rows.select("label", "text").mapInArrow(logits_of, "target long, logits array<double>"), "logits")

    def read(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        return batch.column(0).to_numpy(), np.array(batch.column(1).to_pylist()).reshape(batch.num_rows, -1)

    def losses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            target, logits = read(batch)
            if len(target):
                p = [_softmax(logits / t)[np.arange(len(target)), target] for t in TEMPERATURES]
                loss = -np.log(np.array(p) + 1e-12).sum(axis=1)
                yield pa.RecordBatch.from_pydict({"t": np.arange(len(loss)), "loss": loss})

    sums = held.mapInArrow(losses, "t long, loss double").groupBy("t").agg(F.sum("loss").alias("loss"))
    best = min(sums.collect(), key=lambda r: (round(r.loss, 6), r.t))
    model.temperature = float(TEMPERATURES[best.t])
    temperature = model.temperature

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            target, logits = read(batch)
            if len(target):
                p = _softmax(logits / temperature)
                at = np.floor(p.max(axis=1) * BINS).astype(np.int64)
                yield pa.RecordBatch.from_pydict({"at": at, "wrong": (p.argmax(axis=1) != target).astype(np.int64)})

    bins = held.mapInArrow(scored, "at long, wrong long").groupBy("at")
    bins = bins.agg(F.count("*").alias("n"), F.sum("wrong").alias("wrong")).orderBy(F.desc("at")).collect()
    at, n, wrong = (np.array([r[c] for r in bins], float) for c in range(3))
    _set_threshold(model, at / BINS, n, wrong)
    discard(held)


def identify(model: LanguageModel, docs: DataFrame, text: str = "text") -> Column:
    """Struct column ``lang_pred, score, accepted`` of a text column of ``docs``."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("lang_pred string, score double, accepted boolean")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        names = np.array([*model.languages, UNDETERMINED], object)
        for batch in batches:
            best, score = model.predict(batch)
            yield pa.StructArray.from_arrays(
                [
                    pa.array(names[best], pa.string()),
                    pa.array(score, pa.float64()),
                    pa.array((best >= 0) & (score >= model.threshold)),
                ],
                ["lang_pred", "score", "accepted"],
            )

    return predict(F.col(text))
