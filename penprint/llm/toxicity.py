"""Toxic texts by a linear classifier over character n-grams, scaled by naive Bayes ratios.

A text is the set of its character n-grams, hashed to ``2 ** BITS`` features. From the
labelled texts each feature gets the log of its share in toxic over its share in other
texts; a logistic regression is trained on the features scaled by that ratio. Scaling
puts the weight on n-grams that tell the classes apart, so few labels suffice.

Training reads a bounded sample: about ``TRAIN_ROWS`` labelled rows and ``TRAIN_CHARS``
characters at most, chosen by a hash of the id, in one task. Scoring reads every text
where it lies, whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from penprint.llm.common import fold_of
from penprint.llm.optimise import minimise

BITS = 20
ORDERS = (3, 5, 7, 9)
TRAIN_ROWS = 20_000
TRAIN_CHARS = 64_000_000
LEAST_TEXTS = 8
LEAST_RATIO = 1.5
SMOOTH = 1.0
# strength of the prior on the coefficients, per training row
PENALTY = 1 / 60_000
STEPS = 25
THRESHOLD = 0.3
_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


class Hasher:
    """Distinct n-gram features of texts."""

    def __init__(self):
        self.stamp = np.zeros(1 << BITS, np.int32)

    def features(self, text: str) -> np.ndarray:
        """Distinct features of a text in lower case with a blank at both ends; empty for an empty text."""
        if not text:
            return np.zeros(0, np.int32)
        points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        hashed = points * _MULTIPLY
        found = []
        for k in range(2, ORDERS[-1] + 1):
            if len(points) < k:
                break
            hashed = (hashed[: len(points) - k + 1] ^ (hashed[: len(points) - k + 1] >> np.uint64(29))) * _MIX
            hashed = hashed + points[k - 1 :] * _MULTIPLY
            if k in ORDERS:
                found.append((hashed * _MULTIPLY) >> np.uint64(64 - BITS))
        if not found:
            return np.zeros(0, np.int32)
        all_of = np.concatenate(found).astype(np.int32)
        # the last place of each feature stands for it
        places = np.arange(len(all_of), dtype=np.int32)
        self.stamp[all_of] = places
        return all_of[self.stamp[all_of] == places]


def log_ratios(features: Iterable[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Log-count ratio of each feature; zero if it is rare or the ratio is below ``LEAST_RATIO``.

    A rare feature is one in fewer than ``LEAST_TEXTS`` texts, less for a small sample.
    """
    size = 1 << BITS
    toxic = np.zeros(size)
    other = np.zeros(size)
    for f, y in zip(features, labels):
        (toxic if y else other)[f] += 1
    p, q = toxic + SMOOTH, other + SMOOTH
    ratio = np.log(p / p.sum()) - np.log(q / q.sum())
    least = min(LEAST_TEXTS, max(3, len(labels) // 300))
    ratio[(toxic + other < least) | (np.abs(ratio) < LEAST_RATIO)] = 0
    return ratio


def fit(read: Callable[[], Iterable[np.ndarray]], labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Weights of the features (ratio times coefficient), squares of the ratios, and the intercept.

    ``read`` gives the features of the texts; it is called twice, so that only those that
    take part are held. With one class only every text gets the share of that class;
    without any row, zero.
    """
    if not len(labels):
        return np.zeros(1 << BITS, np.float32), np.zeros(1 << BITS, np.float32), -50.0
    labels = np.asarray(labels, np.float64)
    share = (labels.sum() + 0.5) / (len(labels) + 1)
    start = float(np.log(share / (1 - share)))
    if not labels.any() or labels.all():
        return np.zeros(1 << BITS, np.float32), np.zeros(1 << BITS, np.float32), start
    ratio = log_ratios(read(), labels)
    # only features with a ratio take part
    used = np.flatnonzero(ratio)
    if not len(used):
        return np.zeros(1 << BITS, np.float32), np.zeros(1 << BITS, np.float32), start
    number = np.full(1 << BITS, -1, np.int32)
    number[used] = np.arange(len(used))
    own = [found[found >= 0] for found in (number[f] for f in read())]
    sizes = np.array([len(f) for f in own])
    column = np.concatenate(own)
    row = np.repeat(np.arange(len(own), dtype=np.int32), sizes)
    scale = ratio[used].astype(np.float32)
    # a text's vector has length one, so that long texts do not outweigh short ones
    norm = 1 / np.sqrt(np.bincount(row, (scale * scale)[column], len(labels)) + 1e-9)
    order = np.argsort(column, kind="stable")
    by_column, column_row = np.bincount(column, minlength=len(used)), row[order]
    first = np.cumsum(by_column) - by_column
    row_first, filled = np.cumsum(sizes) - sizes, sizes > 0

    strength = PENALTY * len(labels)

    def loss(x):
        w, b = x[:-1], x[-1]
        margin = np.full(len(labels), b)
        margin[filled] += norm[filled] * np.add.reduceat((scale * w).astype(np.float32)[column], row_first[filled], dtype=np.float64)
        p = 1 / (1 + np.exp(-margin))
        out = np.logaddexp(0, margin).sum() - (labels * margin).sum() + 0.5 * strength * (w @ w)
        error = p - labels
        grad = scale * np.add.reduceat((error * norm)[column_row], first) + strength * w
        return out, np.append(grad, error.sum())

    x = minimise(loss, np.append(np.zeros(len(used)), start), STEPS)
    weights = np.zeros(1 << BITS, np.float32)
    weights[used] = x[:-1] * scale
    return weights, (ratio * ratio).astype(np.float32), float(x[-1])


def probability(found: np.ndarray, weights: np.ndarray, squares: np.ndarray, intercept: float) -> float:
    """Probability that a text with these features is toxic."""
    margin = intercept
    if len(found):
        margin += float(weights[found].sum(dtype=np.float64)) / float(np.sqrt(squares[found].sum(dtype=np.float64) + 1e-9))
    return float(1 / (1 + np.exp(-margin)))


def _fit_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher, texts, labels, read = Hasher(), [], [], 0
    for batch in batches:
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            read += len(text)
            if read <= TRAIN_CHARS:
                texts.append(text)
                labels.append(label)
    weights, squares, intercept = fit(lambda: map(hasher.features, texts), np.array(labels))
    yield pa.RecordBatch.from_arrays(
        [pa.array([weights.tobytes()]), pa.array([squares.tobytes()]), pa.array([intercept])],
        ["weights", "squares", "intercept"],
    )


def train(docs: DataFrame, labels: DataFrame, use: Column, train_rows: int = TRAIN_ROWS):
    """The fitted model. ``use``: condition on ``doc_id`` of the labels that may be learned.

    A document with several labels is toxic if one of them says so; rows whose label or
    id is null are not used.
    """
    own = labels.where(use & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", "toxic")
    most = max(own.count() / train_rows, 1.0)
    draw = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 30))
    sample = own.where(draw < int((1 << 30) / most)).groupBy("doc_id").agg(F.max("toxic").alias("label"))
    # about train_rows rows of two numbers
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(sample), "doc_id")
    one = rows.repartition(1).sortWithinPartitions(F.xxhash64("doc_id", F.lit(7)), "doc_id", "text")
    fitted = one.select("text", "label").mapInArrow(_fit_task, "weights binary, squares binary, intercept double").first()
    return tuple(fitted or (bytes(4 << BITS), bytes(4 << BITS), -50.0))


def toxic_score(model: tuple):
    """Column function: the probability of each text; null counts as empty."""
    sent = _broadcast(model)

    @arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        weights, squares, intercept = sent.value
        weights, squares = np.frombuffer(weights, np.float32), np.frombuffer(squares, np.float32)
        hasher = Hasher()
        return pa.array(
            [probability(hasher.features(t or ""), weights, squares, intercept) for t in text.to_pylist()], pa.float64()
        )

    return score


def _broadcast(value):
    from pyspark.sql import SparkSession

    return SparkSession.active().sparkContext.broadcast(value)


def scored(docs: DataFrame, labels: DataFrame, name: str = "score", folds: int = 4, fold: int = 2) -> DataFrame:
    """Add the probability that each text is toxic.

    ``docs`` needs ``doc_id`` and ``text``, ``labels`` needs ``doc_id`` and ``toxic``;
    other columns are neither read for the score nor lost, but one called ``name`` is
    replaced. Labels whose ids are in fold
    ``fold`` of ``folds`` are not learned. Null and empty texts get the share of toxic
    texts among those learned; without any label all scores are zero.
    """
    model = train(docs, labels, fold_of(F.col("doc_id"), folds) != fold)
    return docs.withColumn(name, toxic_score(model)(F.col("text")))
