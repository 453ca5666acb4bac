"""Toxicity by a convolutional text classifier over hashed word embeddings.

A word's embedding is the scaled sum of the embeddings of its hashed byte n-grams and of
the hashed word itself, so spellings that share a stem share evidence.  The first dimension
starts from the log-odds of a bucket in the two classes, the others at random.  Filters of one, two
and three words slide over the whole text, the maximum of each filter is kept, and a linear
layer over the rectified maxima gives the score.  Everything is trained in numpy on all usable
labelled rows: log-odds are counted over all of them, one task trains on each shard from there,
and the parameters of the shards are averaged.  A threshold for each language, set on rows
that were not trained on, is moved to a score of one half; the language is the one predicted
from the text, so neither a label nor a language column is an input of a score.

Whole texts are scored, whatever their length.  Null and empty texts get the score of a
text without evidence.  Without labelled rows of both kinds every score is 0.  Repeated
rows get the same score, and empty tables give empty results.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stormgauge.llm.common import PARTS_SCHEMA, averaged, discard, sliced, small_batches, staged, training_rows
from stormgauge.llm.langid import BITS, LanguageModel, distinct_grams
from stormgauge.llm.langid import SIZES as LANGUAGE_SIZES
from stormgauge.llm.words import Words, chunks

# the language model reads the first rows of n-grams, this one the last ones and the word
SIZES = (*LANGUAGE_SIZES, 5)
OWN = slice(2, None)
DIMENSIONS = 8
FILTERS = {1: 8, 2: 4, 3: 4}
# texts by which the log-odds of a bucket are drawn to zero
SHRINK = 4.0
# a shard goes over its rows until it has seen about so many, once at least, EPOCHS times at most
ROWS_SEEN = 5_000
EPOCHS = 4
BATCH = 32
RATE = 0.05
# steps of a logit when thresholds are set
BINS = 64


@dataclass
class ToxicityModel:
    embedding: np.ndarray | None
    filters: dict[int, np.ndarray] = field(default_factory=dict)  # width -> (width, D, F)
    bias: dict[int, np.ndarray] = field(default_factory=dict)
    weights: np.ndarray | None = None
    offset: float = 0.0
    threshold: dict[str, float] = field(default_factory=dict)  # "" is any language
    slope: float = 1.0

    def pooled(self, vectors: np.ndarray, inverse: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Maxima of all filters over each text; ``vectors`` holds its distinct words.

        A distinct word is multiplied with each slot of a filter once; sliding a filter is
        adding such products.  Slots behind a text's last word are empty.
        """
        out = []
        texts = len(first) - 1
        filled = np.flatnonzero(np.diff(first) > 0)
        for width, filters in self.filters.items():
            best = np.zeros((texts, filters.shape[2]), np.float32)
            if len(filled):
                value = np.zeros((len(inverse), filters.shape[2]), np.float32)
                for slot in range(width):
                    product = np.concatenate((vectors @ filters[slot], np.zeros((1, filters.shape[2]), np.float32)))
                    value += product[_shifted(inverse, first, slot, len(vectors))]
                best[filled] = np.maximum.reduceat(value, first[filled], axis=0) + self.bias[width]
            out.append(np.maximum(best, 0))
        return np.concatenate(out, axis=1)

    def logits(self, words: Words, marked) -> np.ndarray:
        inverse, buckets, first = marked
        vectors = _vectors(self.embedding, words, inverse, buckets, first)
        return self.pooled(vectors, inverse, words.first) @ self.weights + self.offset

    def score(self, logits: np.ndarray, languages: list[str]) -> np.ndarray:
        least = np.array([self.threshold.get(x, self.threshold[""]) for x in languages])
        return 1 / (1 + np.exp(-np.clip(self.slope * (logits - least), -40, 40)))


def _shifted(inverse: np.ndarray, first: np.ndarray, slot: int, none: int) -> np.ndarray:
    """Word at ``slot`` places behind each position, ``none`` beyond the text's end."""
    if not slot:
        return inverse
    out = np.full(len(inverse), none, np.int64)
    out[:-slot] = inverse[slot:]
    for back in range(1, slot + 1):
        # the last places of each text, also where a text has fewer words
        at = first[1:] - back
        out[at[at >= first[:-1]]] = none
    return out


def _word_buckets(words: Words, inverse: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Bucket of each distinct word as a whole."""
    distinct = np.zeros(len(first) - 1, np.uint64)
    distinct[inverse] = words.hash
    return (distinct >> np.uint64(64 - BITS)).astype(np.int64)


def _vectors(embedding, words, inverse, buckets, first) -> np.ndarray:
    """Embedding of each distinct word of a chunk."""
    if not len(first) - 1:
        return np.zeros((0, DIMENSIONS), np.float32)
    own = buckets[OWN]
    sums = embedding[own[0]]
    for row in own[1:]:
        sums += embedding[row]
    count = np.add.reduceat((own < 1 << BITS).sum(axis=0), first[:-1]) + 1
    vectors = np.add.reduceat(sums, first[:-1], axis=0)
    vectors += embedding[_word_buckets(words, inverse, first)]
    return vectors / np.sqrt(count)[:, None].astype(np.float32)


@dataclass
class _Sample:
    """Training texts as indices of distinct words, and the buckets of those words."""

    texts: list[np.ndarray]
    bucket: np.ndarray
    first: np.ndarray


def _sample(texts: pa.ChunkedArray) -> _Sample:
    places, distinct, found, sizes, n_words = [], [], [], [], 0
    for _, count, words in chunks(texts):
        inverse, buckets, first = distinct_grams(words, SIZES)
        whole = _word_buckets(words, inverse, first)
        own = np.zeros(len(whole), np.uint64)
        own[inverse] = words.hash
        grams = buckets[OWN].T
        valid = grams < 1 << BITS
        size = np.add.reduceat(valid.sum(axis=1), first[:-1]) if len(whole) else first[:0]
        # the bucket of the whole word comes behind those of its n-grams
        found.append(np.insert(grams[valid], np.cumsum(size), whole).astype(np.uint16))
        sizes.append(size + 1)
        distinct.append(own)
        edge, at = words.first, (inverse + n_words).astype(np.int32)
        places += [at[edge[k] : edge[k + 1]] for k in range(count)]
        n_words += len(whole)
    if not n_words:
        return _Sample(places, np.zeros(0, np.uint16), np.zeros(1, np.int64))
    # words of several chunks become one
    size = np.concatenate(sizes)
    _, first, same = np.unique(np.concatenate(distinct), return_index=True, return_inverse=True)
    kept = _ranges((np.cumsum(size) - size)[first], size[first])
    same = same.astype(np.int32)
    edges = np.concatenate(([0], np.cumsum(size[first], dtype=np.int64)))
    return _Sample([same[p] for p in places], np.concatenate(found)[kept], edges)


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    ends = np.cumsum(size)
    return np.repeat(first - ends + size, size) + np.arange(int(ends[-1]) if len(ends) else 0)


def _gather(model: ToxicityModel, sample: _Sample, word: np.ndarray):
    """Vectors of some distinct words, their buckets, and the bucket counts."""
    size = sample.first[word + 1] - sample.first[word]
    bucket = sample.bucket[_ranges(sample.first[word], size)]
    start = np.cumsum(size) - size
    vectors = np.add.reduceat(model.embedding[bucket], start, axis=0)
    return vectors / np.sqrt(size)[:, None].astype(np.float32), bucket, size


def train(
    texts,
    toxic: list[int],
    languages: list[str],
    epochs: int = EPOCHS,
    batch: int = BATCH,
    rate: float = RATE,
    seed: int = 3,
) -> ToxicityModel:
    """Fit a model to a list or an Arrow column of texts; a fifth only sets thresholds and slope.

    ``languages`` are the predicted languages of the texts, for the thresholds.
    """
    target = np.array(toxic, np.float32)
    if len(set(toxic)) < 2:
        return ToxicityModel(None)
    rng = np.random.default_rng(seed)
    model = _random_model(rng)
    sample = _sample(pa.array(texts, pa.string()) if isinstance(texts, list) else texts)
    order = rng.permutation(len(texts))
    del texts
    held, fit = order[: len(order) // 5], order[len(order) // 5 :]
    counts = np.bincount(target[fit].astype(int), minlength=2)
    _start(model, _seen(sample, fit, target), counts)
    _descend(model, sample, fit, target, counts, epochs, rng, batch, rate)
    held = held if len(set(target[held])) == 2 else order
    logits = np.concatenate(
        [_forward(model, sample, held[i : i + 64]) for i in range(0, len(held), 64)]
    )
    _calibrate(model, logits, target[held], [languages[i] for i in held])
    return model


def _random_model(rng) -> ToxicityModel:
    return ToxicityModel(
        np.concatenate((rng.normal(0, 0.1, (1 << BITS, DIMENSIONS)), np.zeros((1, DIMENSIONS)))).astype(np.float32),
        {w: rng.normal(0, 0.3, (w, DIMENSIONS, f)).astype(np.float32) for w, f in FILTERS.items()},
        {w: np.zeros(f, np.float32) for w, f in FILTERS.items()},
        np.abs(rng.normal(0, 0.1, sum(FILTERS.values()))).astype(np.float32),
    )


def _descend(model, sample, fit, target, counts, epochs, rng, batch=BATCH, rate=RATE) -> None:
    """Train on the rows ``fit``; ``counts`` are the training rows of both classes."""
    # the rarer class weighs as much as the other one
    share = float(np.clip(counts[1] / counts.sum(), 0.01, 0.99))
    weight = np.where(target == 1, 0.5 / share, 0.5 / (1 - share))
    squares = _Squares(model)
    for epoch in range(epochs):
        shuffled = rng.permutation(fit)
        for i in range(0, len(shuffled), batch):
            now = rate * (1 - (epoch if epochs > 1 else i / len(shuffled)) / epochs)
            _step(model, squares, sample, shuffled[i : i + batch], target, weight, now, rng)


def _seen(sample: _Sample, rows: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Texts of each class that hold a bucket."""
    seen = np.zeros((2, 1 << BITS))
    for i in rows:
        word = np.unique(sample.texts[i])
        size = sample.first[word + 1] - sample.first[word]
        seen[int(target[i]), np.unique(sample.bucket[_ranges(sample.first[word], size)])] += 1
    return seen


def _start(model: ToxicityModel, seen: np.ndarray, counts: np.ndarray) -> None:
    """Put the shrunk log-odds of each bucket into the first dimension and point filters at it."""
    share = counts[:, None] / counts.sum()
    more = np.log((seen + SHRINK) / (seen.sum(axis=0) * share + SHRINK))
    model.embedding[:-1, 0] = more[1] - more[0]
    column = 0
    for width, filters in model.filters.items():
        for f in range(0, filters.shape[2], 2):
            filters[:, 0, f] = 0.5 / width
            model.weights[column + f] = 0.2
        column += filters.shape[2]


class _Squares:
    """Sums of squared gradients, by which each parameter's step is divided."""

    def __init__(self, model: ToxicityModel):
        self.embedding = np.full(len(model.embedding), 1e-2, np.float32)
        self.dense = {id(p): np.full_like(p, 1e-2) for p in self._dense(model)}

    @staticmethod
    def _dense(model):
        return [*model.filters.values(), *model.bias.values(), model.weights]

    def move(self, parameter: np.ndarray, gradient: np.ndarray, rate: float) -> None:
        held = self.dense[id(parameter)]
        held += gradient**2
        parameter -= rate * gradient / np.sqrt(held)


def _forward(model: ToxicityModel, sample: _Sample, rows: np.ndarray) -> np.ndarray:
    texts = [sample.texts[i] for i in rows]
    first = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    word, inverse = np.unique(np.concatenate(texts), return_inverse=True)
    if not len(word):
        return np.full(len(rows), model.offset)
    vectors, _, _ = _gather(model, sample, word)
    return model.pooled(vectors, inverse, first) @ model.weights + model.offset


def _step(model, squares, sample, rows, target, weight, rate, rng) -> None:
    """One step of gradient descent; only the words at a filter's maximum get a gradient."""
    texts = [sample.texts[i] for i in rows]
    # leaving out words makes the filters learn more than the most frequent ones
    texts = [t[rng.random(len(t)) > 0.2] for t in texts]
    kept = [k for k, t in enumerate(texts) if len(t)]
    if not kept:
        return
    texts, rows = [texts[k] for k in kept], rows[kept]
    first = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    word, inverse = np.unique(np.concatenate(texts), return_inverse=True)
    vectors, bucket, size = _gather(model, sample, word)
    padded = np.concatenate((vectors, np.zeros((1, DIMENSIONS), np.float32)))
    places, values = {}, []
    for width, filters in model.filters.items():
        value = np.zeros((len(inverse), filters.shape[2]), np.float32)
        slots = [_shifted(inverse, first, s, len(vectors)) for s in range(width)]
        for slot, at in enumerate(slots):
            value += (padded @ filters[slot])[at]
        top = np.stack([value[a:b].argmax(axis=0) + a for a, b in zip(first[:-1], first[1:])])
        places[width] = [at[top] for at in slots]
        values.append(np.take_along_axis(value, top, 0) + model.bias[width])
    pooled = np.maximum(np.concatenate(values, axis=1), 0)
    logit = pooled @ model.weights + model.offset
    error = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - target[rows]) * weight[rows] / len(rows)
    back = (error[:, None] * model.weights[None, :]) * (pooled > 0)
    d_vectors = np.zeros_like(padded)
    column = 0
    for width, filters in model.filters.items():
        n = filters.shape[2]
        g = back[:, column : column + n].astype(np.float32)
        column += n
        d_filters = np.zeros_like(filters)
        for slot, at in enumerate(places[width]):
            d_filters[slot] = np.einsum("df,dfe->ef", g, padded[at])
            np.add.at(d_vectors, at.ravel(), (g[..., None] * filters[slot].T).reshape(-1, DIMENSIONS))
        squares.move(filters, d_filters, rate)
        squares.move(model.bias[width], g.sum(axis=0), rate)
    squares.move(model.weights, (pooled.T @ error).astype(np.float32), rate)
    # maxima are evidence for toxicity only, so a text without evidence scores least
    np.maximum(model.weights, 0, out=model.weights)
    model.offset -= float(rate * error.sum())
    moved = np.flatnonzero(np.abs(d_vectors[:-1]).sum(axis=1))
    if not len(moved):
        return
    start = np.cumsum(size) - size
    at = bucket[_ranges(start[moved], size[moved])]
    each = np.repeat(d_vectors[moved] / np.sqrt(size[moved])[:, None], size[moved], axis=0)
    touched, inverse = np.unique(at, return_inverse=True)
    g = np.stack([np.bincount(inverse, each[:, d], len(touched)) for d in range(DIMENSIONS)], 1).astype(np.float32)
    squares.embedding[touched] += (g**2).mean(axis=1)
    model.embedding[touched] -= rate * g / np.sqrt(squares.embedding[touched])[:, None]


def _best_threshold(logits: np.ndarray, target: np.ndarray, n: np.ndarray) -> float:
    """The cut with the fewest errors; of equal ones the middle of the widest gap."""
    order = np.argsort(logits)
    x, y, n = logits[order], target[order], n[order]
    edges = np.concatenate(([x[0] - 2], x, [x[-1] + 2]))
    wrong = np.concatenate(([0], np.cumsum(n * y))) + (n * (1 - y)).sum() - np.concatenate(([0], np.cumsum(n * (1 - y))))
    gap = np.diff(edges)
    # no cut tells equal logits apart
    wrong[gap == 0] = np.inf
    best = np.flatnonzero(wrong == wrong.min())
    k = best[np.argmax(gap[best])]
    return float(edges[k] + min(gap[k] / 2, 4.0 if k else 2.0))


def _calibrate(model, logits, target, languages, times=None) -> None:
    """Thresholds and slope from rows, each of which counts ``times`` times."""
    times = np.ones(len(target)) if times is None else times
    model.threshold = {"": _best_threshold(logits, target, times)}
    names = np.array(languages, object)
    for name in sorted(set(languages)):
        own = names == name
        n = int(min(times[own & (target == 1)].sum(), times[own & (target == 0)].sum()))
        if n:
            # a language with few rows stays close to the common threshold
            best = _best_threshold(logits[own], target[own], times[own])
            model.threshold[name] = (n * best + 30 * model.threshold[""]) / (n + 30)
    least = np.array([model.threshold.get(n, model.threshold[""]) for n in languages])

    def loss(slope):
        z = np.clip(slope * (logits - least), -30, 30)
        each = np.log1p(np.exp(-z)) * target + np.log1p(np.exp(z)) * (1 - target)
        return np.average(each, weights=times)

    model.slope = float(min(np.geomspace(0.1, 10, 40), key=loss))


def fit_toxicity_model(
    docs: DataFrame,
    labels: DataFrame,
    usable: Column,
    language_model: LanguageModel,
    doc_id: str = "doc_id",
    text: str = "text",
) -> ToxicityModel:
    """Model learned from all labelled rows where ``usable`` (over ``doc_id``) holds.

    A document labelled twice counts as toxic if one label says so.
    """
    small_batches(docs.sparkSession)
    rated = labels.select(F.col("doc_id"), F.col("toxic")).where(
        usable & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()
    )
    rated = rated.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label"))
    # bytes are counted before the join, so that adding them up shuffles no text
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.octet_length(text).alias("bytes"))
    texts = texts.where(usable)
    rows = staged(training_rows(texts.join(rated, "doc_id"), deal=False), "training-rows")
    n = {(r.held, r.label): r["count"] for r in rows.groupBy("held", "label").count().collect()}
    if not all(n.get((False, x), 0) + n.get((True, x), 0) for x in (0, 1)):
        discard(rows)
        return ToxicityModel(None)
    apart = all(n.get((held, x)) for held in (False, True) for x in (0, 1))
    fit = rows.where("not held") if apart else rows
    counts = np.array([n.get((False, x), 0) + (0 if apart else n.get((True, x), 0)) for x in (0, 1)])
    model = _random_model(np.random.default_rng(3))
    _start(model, _all_seen(fit), counts)
    model = _average_model(model, fit, counts)
    _calibrate_all(model, language_model, rows.where("held") if apart else rows)
    discard(rows)
    return model


def _all_seen(rows: DataFrame) -> np.ndarray:
    """Texts of each class that hold a bucket, over all rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, 1 << BITS))
        for batch in batches:
            target = batch.column(0).to_numpy()
            for row, n, words in chunks(batch.column(1)):
                inverse, buckets, first = distinct_grams(words, SIZES)
                own, whole, edge = buckets[OWN], _word_buckets(words, inverse, first), words.first
                for k in range(n):
                    word = np.unique(inverse[edge[k] : edge[k + 1]])
                    here = np.zeros((1 << BITS) + 1, bool)
                    here[own[:, _ranges(first[word], first[word + 1] - first[word])]] = True
                    here[whole[word]] = True
                    seen[target[row + k]] += here[:-1]
        label, bucket = np.nonzero(seen)
        n = seen[label, bucket].astype(np.int64)
        yield pa.RecordBatch.from_pydict({"label": label, "bucket": bucket, "n": n})

    found = rows.select("label", "text").mapInArrow(count, "label long, bucket long, n long")
    found = found.groupBy("label", "bucket").agg(F.sum("n").alias("n")).toArrow()
    seen = np.zeros((2, 1 << BITS))
    seen[found["label"].to_numpy(), found["bucket"].to_numpy()] = found["n"].to_numpy()
    return seen


def _parameters(model: ToxicityModel) -> list[np.ndarray]:
    return [model.embedding, *model.filters.values(), *model.bias.values(), model.weights]


def _average_model(start: ToxicityModel, rows: DataFrame, counts: np.ndarray, seed: int = 3) -> ToxicityModel:
    """Mean of the models that the shards of ``rows`` train from one start."""
    shared = rows.sparkSession.sparkContext.broadcast(start)

    def part(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending")])
        model, rng, n = copy.deepcopy(shared.value), np.random.default_rng(seed), table.num_rows
        target = table["label"].to_numpy().astype(np.float32)
        epochs = int(np.clip(np.rint(ROWS_SEEN / n), 1, EPOCHS))
        _descend(model, _sample(table["text"]), np.arange(n), target, counts, epochs, rng)
        vector = np.concatenate([*(p.ravel() for p in _parameters(model)), [model.offset]])
        return sliced(table["shard"][0].as_py(), n, vector)

    vector = averaged(rows.drop("held").groupBy("shard").applyInArrow(part, PARTS_SCHEMA))
    model, at = copy.deepcopy(start), 0
    for p in _parameters(model):
        p[...] = vector[at : at + p.size].reshape(p.shape)
        at += p.size
    model.offset = float(vector[at])
    return model


def _calibrate_all(model: ToxicityModel, language_model: LanguageModel, rows: DataFrame) -> None:
    """As ``_calibrate``, on counts of rows by language, class and step of the logit."""
    shared = rows.sparkSession.sparkContext.broadcast((model, language_model))

    def logits_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, language_model = shared.value
        names = np.array([*language_model.languages, ""], object)
        for batch in batches:
            label = batch.column(0)
            for row, count, words in chunks(batch.column(1)):
                marked = distinct_grams(words, SIZES)
                best = np.full(count, -1)
                if language_model.languages:
                    best, _ = language_model.choose(language_model.logits(words, marked))
                best[words.per_text == 0] = -1
                at = np.rint(model.logits(words, marked) * BINS).astype(np.int64)
                columns = {"label": label.slice(row, count), "language": pa.array(names[best], pa.string()), "at": at}
                yield pa.RecordBatch.from_pydict(columns)

    found = rows.select("label", "text").mapInArrow(logits_of, "label int, language string, at long")
    found = found.groupBy("language", "at", "label").count().orderBy("language", "at", "label").toArrow()
    columns = [found[c].to_numpy() for c in ("at", "label", "count")]
    _calibrate(model, columns[0] / BINS, columns[1], found["language"].to_pylist(), columns[2].astype(float))


def rate(model: ToxicityModel, language_model: LanguageModel, docs: DataFrame, text: str = "text") -> Column:
    """Column of the scores of a text column of ``docs``; one half and more means toxic."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((model, language_model))

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model, language_model = shared.value
        names = [*language_model.languages, ""]
        for batch in batches:
            out = np.zeros(len(batch))
            for row, count, words in chunks(batch) if model.embedding is not None else ():
                marked = distinct_grams(words, SIZES)
                best = np.full(count, -1)
                if language_model.languages:
                    best, _ = language_model.choose(language_model.logits(words, marked))
                best[words.per_text == 0] = -1
                logits = model.logits(words, marked)
                out[row : row + count] = model.score(logits, [names[b] for b in best])
            yield pa.array(out, pa.float64())

    return score(F.col(text))
