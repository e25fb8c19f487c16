"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy.

A word's embedding is the sum of hashed vectors of the word and of its first four and five bytes, so
inflected and compound forms share what they begin with. Filters one, two and three words wide run over the
whole text, each keeps its largest response, and a logistic layer weighs these. Thresholds are
calibrated by language on all labelled rows that the fit hasn't seen, from their numbers by language, label and score bin;
language is no input of the score.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tapflow.llm import shared, words as W

#: Labelled rows of either class that a model is fitted on, at most, with those of them that only calibrate.
ROWS_PER_CLASS = 4_000
#: Every so many-th of them calibrates thresholds, with all labelled rows beyond them.
CALIBRATE = 5
#: Bins of scores that thresholds are chosen from.
BINS = 1_000
BUCKETS, DIM, FILTERS, WIDTHS = 1 << 16, 8, 8, (1, 2, 3)
EPOCHS, BATCH, RATE = 8, 40, 0.15
#: Share of words whose own vector is left out in training, so that their beginnings have to carry it too.
DROPPED = 0.5
PREFIXES = (4, 5)
PAD = 3 * BUCKETS  # the row of zeros between two texts
LETTERS = W.byte_class((97, 122))


@dataclass
class Model:
    """Embeddings (the last row is zeros), kernels by width, weights of the pooled responses, thresholds."""

    table: np.ndarray
    kernels: list[np.ndarray]
    weights: np.ndarray
    bias: float
    threshold: float = 0.5
    thresholds: dict[str, float] = field(default_factory=dict)

    def limit(self, lang: str | None) -> float:
        return self.thresholds.get(lang, self.threshold)


def word_ids(texts: W.Flat) -> tuple[np.ndarray, np.ndarray]:
    """Three table rows for each word, and the first word of each text."""
    folded = W.LOWER[texts.data]
    words = W.words_of(W.Flat(folded, texts.offsets), LETTERS)
    ends = [words.ends, *(np.minimum(words.ends, words.starts + n) for n in PREFIXES)]
    rows = [
        (h % np.uint64(BUCKETS)).astype(np.int32) + i * BUCKETS
        for i, h in enumerate(W.hashes(folded, words.starts, *ends))
    ]
    return np.stack(rows), words.first


def padded(ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words with padding behind each text, and where filters begin in it: at its words and the padding next to them.

    So no filter reaches into the next text or stays empty. The ends are exclusive.
    """
    counts, gap = np.diff(first), max(WIDTHS)
    at = first[:-1] + np.arange(len(counts)) * gap
    out = np.full((len(ids), len(ids[0]) + len(counts) * gap), PAD, np.int32)
    if len(ids[0]):
        out[:, W.ragged(at, counts)] = ids
    return out, at, at + counts + 1


def _embedded(model: Model, ids: np.ndarray) -> np.ndarray:
    x = model.table[ids[0]]
    for row in ids[1:]:
        x += model.table[row]
    return x


def _responses(model: Model, x: np.ndarray) -> list[np.ndarray]:
    """Of each width, filters by places."""
    out = []
    for kernel in model.kernels:
        r = kernel[0].T @ x.T
        for j in range(1, len(kernel)):
            r[:, :-j] += kernel[j].T @ x[j:].T
        out.append(r)
    return out


def _largest(responses: np.ndarray, at: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Filters by texts: the largest response from `at` to `ends`."""
    return np.maximum.reduceat(responses, np.stack([at, ends], axis=1).reshape(-1), axis=1)[:, ::2]


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def scores(model: Model, texts: W.Flat) -> np.ndarray:
    """The score of each text, from all of its words."""
    out = np.empty(len(texts.offsets) - 1)
    for start, piece in W.pieces(texts, 1 << 20):
        ids, at, ends = padded(*word_ids(piece))
        pooled = np.concatenate([_largest(r, at, ends) for r in _responses(model, _embedded(model, ids))])
        z = model.weights @ np.maximum(pooled, 0) + model.bias
        out[start : start + len(at)] = _sigmoid(z.astype(np.float64))
    return out


def fit(examples: list[np.ndarray], labels: np.ndarray, rate: float, seed: int = 7) -> Model:
    """Fit on word rows of texts (3 x words each). `rate` is the share of label 1 among all labelled rows."""
    rng = np.random.default_rng(seed)
    model = Model(
        np.vstack([rng.normal(0, 0.3, (3 * BUCKETS, DIM)), np.zeros((1, DIM))]).astype(np.float32),
        [rng.normal(0, 0.5 / np.sqrt(w), (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS],
        rng.normal(0, 0.3, FILTERS * len(WIDTHS)).astype(np.float32),
        0.0,
    )
    prior = np.log((rate + 1e-4) / (1 - rate + 1e-4))
    if len(set(labels.tolist())) < 2:
        model.weights[:], model.bias = 0, prior
        return model
    seen_table = np.full(len(model.table), 1e-6, np.float32)
    seen = [np.full_like(k, 1e-6) for k in model.kernels]
    seen_w, seen_b = np.full_like(model.weights, 1e-6), 1e-6
    for epoch in range(EPOCHS):
        order = rng.permutation(len(examples))
        for begin in range(0, len(order), BATCH):
            chosen = order[begin : begin + BATCH]
            first = np.cumsum([0, *(examples[i].shape[1] for i in chosen)])
            ids, at, ends = padded(np.concatenate([examples[i] for i in chosen], axis=1), first)
            ids[0, rng.random(ids.shape[1]) < DROPPED] = PAD
            x = _embedded(model, ids)
            tops, places = [], []
            for r in _responses(model, x):
                place = np.stack([a + r[:, a:e].argmax(axis=1) for a, e in zip(at, ends, strict=True)])
                places.append(place)
                tops.append(np.take_along_axis(r.T, place, axis=0))
            pooled = np.maximum(np.concatenate(tops, axis=1), 0)
            error = ((_sigmoid(pooled @ model.weights + model.bias) - labels[chosen]) / len(chosen)).astype(np.float32)
            back = np.where(pooled > 0, error[:, None] * model.weights, 0)
            grad_w = pooled.T @ error
            touched, grads = [], []
            for k, (kernel, place) in enumerate(zip(model.kernels, places, strict=True)):
                own = back[:, k * FILTERS : (k + 1) * FILTERS]
                grad = np.empty_like(kernel)
                for j in range(len(kernel)):
                    spot = np.minimum(place + j, len(x) - 1)
                    grad[j] = np.einsum("bfd,bf->df", x[spot], own)
                    flow = own[:, :, None] * kernel[j].T[None]
                    for row in ids:
                        touched.append(row[spot].reshape(-1))
                        grads.append(flow.reshape(-1, DIM))
                seen[k] += grad**2
                kernel -= RATE * grad / np.sqrt(seen[k])
            rows, inverse = np.unique(np.concatenate(touched), return_inverse=True)
            total = np.zeros((len(rows), DIM), np.float32)
            np.add.at(total, inverse, np.concatenate(grads))
            total[rows == PAD] = 0
            seen_table[rows] += (total**2).mean(axis=1)
            model.table[rows] -= RATE * total / np.sqrt(seen_table[rows])[:, None]
            seen_w += grad_w**2
            model.weights -= RATE * grad_w / np.sqrt(seen_w)
            seen_b += float(error.sum()) ** 2
            model.bias -= RATE * float(error.sum()) / np.sqrt(seen_b)
    ones = labels.mean()
    model.bias += float(prior - np.log(ones / (1 - ones)))
    return model


def calibrated(scored: np.ndarray, labels: np.ndarray, default: float = 0.5, times: np.ndarray | None = None) -> float:
    """The threshold with the best mean of both classes' accuracy; the middle of all that are equally good.

    Each score counts so many `times`, once if left out.
    """
    if len(set(labels.tolist())) < 2:
        return default
    times = np.ones(len(scored), np.int64) if times is None else times
    values, at = np.unique(scored, return_inverse=True)
    cuts = np.concatenate([[0.0], values, [1.0]])
    cuts = (cuts[1:] + cuts[:-1]) / 2
    # of each class, how many are below each cut
    ones, zeros = (np.cumsum(np.append(0, np.bincount(at, times * (labels == x), len(values)))) for x in (1, 0))
    right = (ones[-1] - ones) / ones[-1] + zeros / zeros[-1]
    best = cuts[right >= right.max() - 1e-12]
    return float(np.clip((best.min() + best.max()) / 2, 0.2, 0.8))


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, rows_per_class: int = ROWS_PER_CLASS) -> Model:
    """A model from the labelled documents that aren't held out.

    `rows_per_class` bounds the rows collected to the driver for the fit; they're taken by a hash of the id, alike at every
    size. Thresholds see all other labelled rows: those are scored where they are, and only their sums come to the driver.
    Null ids and labels are left out; of several labels of an id the largest counts. Without both
    classes every score is the share of label 1.
    """
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where(
        ~held_out() & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()
    ).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    by_hash = [F.xxhash64(F.col("doc_id").cast("string")), "doc_id"]
    chosen = known.where("toxic = 0").orderBy(*by_hash).limit(rows_per_class).unionAll(
        known.where("toxic = 1").orderBy(*by_hash).limit(rows_per_class)
    )
    own = docs.select("doc_id", shared.text_of(), F.col("lang").cast("string").alias("lang"))
    rows = own.join(F.broadcast(chosen), "doc_id").select("doc_id", "toxic", "lang", "text")  # bounded by rows_per_class

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, first = word_ids(W.flat(batch.column(3)))
            cells = [np.ascontiguousarray(ids[:, a:b]).tobytes() for a, b in itertools.pairwise(first)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(cells, pa.binary())], names=["doc_id", "toxic", "lang", "ids"]
            )

    sample = shared.map_arrow(rows, encoded, shared.with_fields(rows.drop("text").schema, ids="binary"))
    found = sorted(
        sample.dropDuplicates(["doc_id"]).select(F.col("doc_id").cast("string").alias("key"), "toxic", "lang", "ids").collect(),
        key=lambda r: r.key,
    )
    examples = [np.frombuffer(r.ids, np.int32).reshape(3, -1) for r in found]
    marks = np.array([r.toxic for r in found], np.int64)
    rate = n.get(1, 0) / max(1, sum(n.values()))
    last = np.arange(len(found)) % CALIBRATE == CALIBRATE - 1
    model = fit([e for e, x in zip(examples, last, strict=True) if not x], marks[~last], rate)
    fitted = [(r.key,) for r, x in zip(found, last, strict=True) if not x]
    sums = _score_bins(own, known, fitted, model)
    bins, marks, times = (np.array([r[c] for r in sums], np.int64) for c in ("bin", "toxic", "n"))
    middles, langs = (bins + 0.5) / BINS, np.array([r.lang or "" for r in sums])
    model.threshold = calibrated(middles, marks, times=times)
    for lang in set(langs.tolist()) - {""}:
        is_own = langs == lang
        model.thresholds[lang] = calibrated(middles[is_own], marks[is_own], model.threshold, times[is_own])
    return model


def _score_bins(own: DataFrame, known: DataFrame, fitted: list[tuple[str]], model: Model) -> list:
    """Numbers of labelled documents that the fit hasn't seen: lang, toxic, bin, n, one row per language and bin at most."""
    spark = own.sparkSession
    used = spark.createDataFrame(fitted, "key string")  # bounded by the rows of the fit
    rest = known.join(F.broadcast(used), F.col("doc_id").cast("string") == F.col("key"), "left_anti")
    rows = own.where("doc_id IS NOT NULL").select("doc_id", "lang", "text")
    sent = spark.sparkContext.broadcast(model)

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = np.minimum((scores(sent.value, W.flat(batch.column(2))) * BINS).astype(np.int32), BINS - 1)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(bins)], names=["doc_id", "lang", "bin"])

    # scored before the join, so that no text is shuffled
    found = shared.map_arrow(rows, binned, shared.with_fields(rows.drop("text").schema, bin="int"))
    return found.join(rest, "doc_id").groupBy("lang", "toxic", "bin").agg(F.count("*").alias("n")).collect()


def score(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, score, threshold (of its language), toxic (whether the score reaches it).

    Null and empty texts get the score of a text without words; a null or unseen language has the
    threshold of all; repeated documents are scored each.
    """
    rows = docs.select("doc_id", shared.text_of(), F.col("lang").cast("string").alias("lang"))
    sent = rows.sparkSession.sparkContext.broadcast(model)  # some megabytes, whatever the input

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = scores(sent.value, W.flat(batch.column(1)))
            limits = np.array([sent.value.limit(x) for x in batch.column(2).to_pylist()], np.float64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(values), pa.array(limits), pa.array(values >= limits)],
                names=["doc_id", "score", "threshold", "toxic"],
            )

    return shared.map_arrow(rows, scored, shared.with_fields(
        rows.select("doc_id").schema, score="double", threshold="double", toxic="boolean"
    ))


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The documents, all columns, without those whose score reaches the threshold of their language."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    text, lang = docs.columns.index("text"), docs.columns.index("lang")

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = scores(sent.value, W.flat(batch.column(text)))
            limits = np.array([sent.value.limit(x) for x in batch.column(lang).to_pylist()], np.float64)
            yield batch.filter(pa.array(values < limits))

    return shared.map_arrow(docs, kept, docs.schema)
