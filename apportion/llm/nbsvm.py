"""Quality classifier: naive Bayes log-count ratios under a linear support vector machine.

A text's features are indicators of its word n-grams (words and word pairs as
written, the same for the words' shapes, and a word said twice in a row),
hashed into a fixed number of columns. Each column is scaled by its class
log-count ratio; a hinge-loss linear model over the scaled columns is fitted
by dual coordinate descent, and its margin becomes a probability by a logistic
curve fitted on rows that a first model did not see.

The model is fitted on at most ``max_rows`` labelled rows (those of the
smallest id hashes); all rows are scored. Null or empty texts have no
features: their score is that of the model's offset. Without labelled rows of
both classes every score is the share of label 1 (0.5 without labels).
Repeated rows score alike; extra columns are kept or ignored as told.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from apportion.llm.common import kept_in_worker, text_slices, texts

#: Feature columns are 2 to this power.
BITS = 20
#: Labelled rows that a fit reads at most.
MAX_ROWS = 8000
#: Distinct words whose hashes a worker keeps between texts.
CACHED_WORDS = 400_000
_MIX = np.uint64(0x9E3779B97F4A7C15)
_PAIR = np.uint64(0xC2B2AE3D27D4EB4F)
_RUNS = ((re.compile("[a-z\\u00df-\\u00f6\\u00f8-\\u00ff]+"), "a"), (re.compile("[A-Z\\u00c0-\\u00d6\\u00d8-\\u00de]+"), "A"), (re.compile("[0-9]+"), "0"), (re.compile(r"(.)\1+"), r"\1\1"))


def shape(word: str) -> str:
    """The word with runs of small letters, capitals and digits as one sign each, and longer runs of another sign as two."""
    for run, sign in _RUNS:
        word = run.sub(sign, word)
    return word


class Features:
    """Hashed n-gram indicators of texts."""

    def __init__(self) -> None:
        self.forget()

    def forget(self) -> None:
        self.index: dict[bytes, int] = {}
        self.hashes = np.zeros((0, 2), np.uint64)

    def of(self, docs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(document, column) of each indicator, ordered by both, each once."""
        if len(self.index) > CACHED_WORDS:
            self.forget()
        words: list[bytes] = []
        counts = np.empty(len(docs), np.int64)
        for i, text in enumerate(docs):
            split = text.split()
            words += split
            counts[i] = len(split)
        new = list({w for w in words if w not in self.index})
        if new:
            h = [(xxhash.xxh64_intdigest(w), xxhash.xxh64_intdigest(shape(w.decode()).encode(), 1)) for w in new]
            self.hashes = np.concatenate([self.hashes, np.array(h, np.uint64)])
            self.index.update(zip(new, range(len(self.index), len(self.index) + len(new))))
        at = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        doc = np.repeat(np.arange(len(docs)), counts)
        inside = doc[1:] == doc[:-1]
        keys = [(doc, self.hashes[at, 0]), (doc, self.hashes[at, 1])]
        for kind in (0, 1):
            h = self.hashes[at, kind]
            keys.append((doc[1:][inside], (h[:-1] * _PAIR + (h[1:] ^ (h[1:] >> np.uint64(29))))[inside]))
        twice = doc[1:][inside & (at[1:] == at[:-1])]
        keys.append((twice, np.full(len(twice), 7, np.uint64)))
        parts = [(d.astype(np.int64) << BITS) | ((h * _MIX) >> np.uint64(64 - BITS)).astype(np.int64) for d, h in keys]
        pairs = np.unique(np.concatenate(parts))
        return pairs >> BITS, pairs & ((1 << BITS) - 1)


def log_count_ratios(rows: list[np.ndarray], y: np.ndarray, smooth: float = 1.0) -> np.ndarray:
    """log of (share of a column in class 1 / its share in class 0), smoothed."""
    counts = [np.full(1 << BITS, smooth) for _ in (0, 1)]
    for x, label in zip(rows, y):
        counts[int(label)][x] += 1
    return np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())


def dual_coordinate_descent(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, cost: float = 1.0, epochs: int = 20, seed: int = 5) -> tuple[np.ndarray, float]:
    """Weights and offset of a hinge-loss linear model; both classes weigh the same in sum."""
    sign = np.where(y > 0, 1.0, -1.0)
    share = np.array([np.mean(y == 0), np.mean(y == 1)])
    most = cost / (2 * share[y])
    norm = np.array([float(v @ v) + 1.0 for v in values])  # the offset is a column of ones
    w, b, a, rng = np.zeros(1 << BITS), 0.0, np.zeros(len(rows)), np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            x, v = rows[i], values[i]
            gradient = sign[i] * (float(w[x] @ v) + b) - 1
            new = min(max(a[i] - gradient / norm[i], 0.0), most[i])
            if new != a[i]:
                step = (new - a[i]) * sign[i]
                w[x] += step * v
                b += step
                moved = max(moved, abs(step))
                a[i] = new
        if moved < 1e-3:
            break
    return w, b


def logistic_curve(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope (positive) and offset of the probability of label 1 by margin; each class weighs the same in sum."""
    n1, n0 = max(1, int(y.sum())), max(1, int((1 - y).sum()))
    goal = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    weight = np.where(y > 0, 1 / n1, 1 / n0)
    a, b = 2.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        g, h = weight * (p - goal), weight * p * (1 - p) + 1e-6
        step = np.linalg.solve([[(h * margin * margin).sum() + 1e-3, (h * margin).sum()], [(h * margin).sum(), h.sum() + 1e-3]], [(g * margin).sum(), g.sum()])
        a, b = max(a - step[0], 0.5), b - step[1]
    return float(a), float(b)


@dataclass(frozen=True)
class Model:
    """Weight of each column on unit-length scaled rows: margin = (weights . x) / |ratios . x| + offset."""

    weights: np.ndarray
    squares: np.ndarray
    offset: float
    slope: float
    shift: float

    def probability(self, doc: np.ndarray, column: np.ndarray, n: int) -> np.ndarray:
        dots = np.bincount(doc, self.weights[column], n)
        norms = np.sqrt(np.bincount(doc, self.squares[column], n))
        margin = dots / np.maximum(norms, 1e-9) + self.offset
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -30, 30)))


def fit(rows: list[np.ndarray], y: np.ndarray) -> Model:
    """The model of labelled rows (column indexes and 0/1 labels, in a fixed order)."""
    flat = np.zeros(1 << BITS, np.float32)
    if len(set(y.tolist())) < 2:
        share = float(np.clip(y.mean(), 0.01, 0.99)) if len(y) else 0.5
        return Model(flat, flat, 0.0, 1.0, float(np.log(share / (1 - share))))

    def scaled(part: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        ratios = log_count_ratios([rows[i] for i in part], y[part])
        values = []
        for i in part:
            v = ratios[rows[i]]
            values.append(v / max(float(np.sqrt(v @ v)), 1e-9))
        w, b = dual_coordinate_descent([rows[i] for i in part], values, y[part])
        return ratios, w, b

    every = np.arange(len(y))
    seen = every % 4 != 3
    slope, shift = 4.0, 0.0
    if len(set(y[seen])) == len(set(y[~seen])) == 2:
        ratios, w, b = scaled(every[seen])
        first = Model(w * ratios, ratios**2, b, 1.0, 0.0)
        unseen = [rows[i] for i in every[~seen]]
        doc = np.repeat(np.arange(len(unseen)), [len(x) for x in unseen])
        p = first.probability(doc, np.concatenate(unseen), len(unseen))
        slope, shift = logistic_curve(np.log(p / (1 - p)), y[~seen])
    ratios, w, b = scaled(every)
    return Model((w * ratios).astype(np.float32), (ratios**2).astype(np.float32), b, slope, shift)


def held_out_column() -> Column:
    """Rows kept from learning: crc32 of the id as text leaves 1 modulo 3."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 1


def fit_quality(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    """Fit on at most ``max_rows`` documents with a quality label that are not held out."""
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where("doc_id is not null and quality in (0, 1)")
    chosen = usable.where(~held_out_column()).orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(max_rows)
    labelled = chosen.groupBy("doc_id").agg(F.min("quality").alias("label"))  # at most max_rows rows

    def indicators(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = kept_in_worker("features", Features)
        for part in text_slices(batches):
            doc, column = features.of(texts(part))
            cuts = np.searchsorted(doc, np.arange(part.num_rows + 1))
            columns = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(column, pa.int32()))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("label"), columns], names=["doc_id", "label", "columns"])

    texts_of = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")
    # repeated rows of an id count once: the id's smallest text, so the bound on rows holds
    sample = texts_of.join(F.broadcast(labelled), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    got = sample.mapInArrow(indicators, "doc_id long, label int, columns array<int>").toArrow().sort_by("doc_id")
    rows = [np.asarray(x.values) for x in got.column("columns")]
    order = np.argsort([xxhash.xxh64_intdigest(str(i)) for i in got.column("doc_id").to_pylist()], kind="stable") if rows else []
    return fit([rows[i] for i in order], np.array(got.column("label").to_pylist(), np.int64)[order] if rows else np.zeros(0, np.int64))


def with_scores(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``score`` of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of a fixed size, whatever the data

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = kept_in_worker("features", Features)
        for part in text_slices(batches):
            score = shared.value.probability(*features.of(texts(part)), part.num_rows)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(score)], names=["doc_id", "score"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(run, "doc_id long, score double")


def score_quality(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """Every document's score, whether it was held out, and the predicted label."""
    scored = with_scores(docs, fit_quality(docs, labels, max_rows))
    return scored.select("doc_id", held_out_column().alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """The documents predicted good, all columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(fit_quality(docs, labels, max_rows))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = kept_in_worker("features", Features)
        for part in text_slices(batches):
            score = shared.value.probability(*features.of(texts(part)), part.num_rows)
            yield part.filter(pa.array(score >= 0.5))

    return docs.mapInArrow(run, docs.schema)
