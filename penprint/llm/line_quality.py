"""Quality of texts from their lines, by a linear-chain conditional random field.

Every line of a text is good or bad. What a line looks like, what the lines before and
after it look like, and which labels follow each other give the scores of a labelling.
Forward and backward passes give each line's probability of being bad. Their mean,
weighted by the lengths of the lines, is turned into the quality of the text by a
logistic curve fitted on the training texts.

Labels mark texts, not lines. A first fit without transitions takes all lines of a bad
text as bad; in the second, only those stay bad that the first finds likelier bad than
good, and at least the worst one of each bad text.

The passes multiply matrices of two rows and columns, for all lines of a batch at once, in
as many steps as the logarithm of the longest text has bits. The matrix of a text's first
line has equal rows, so nothing crosses from one text to the next.

Training reads a bounded sample of about ``TRAIN_ROWS`` labelled texts, ``TRAIN_LINES`` lines
at most, in one task; a text that would exceed the rest of the lines is left out, later
ones are not. Scoring reads every text where it lies, whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from penprint.llm.common import fold_of, joined_bytes, run_sums, slices
from penprint.llm.optimise import minimise

TRAIN_ROWS = 10_000
TRAIN_LINES = 400_000
SLICE = 4 << 20
STEPS = 60
PENALTY = 0.3
THRESHOLD = 0.5
# the mean of bad lines is kept this far from 0 and 1 on the logistic curve
MARGIN = 1e-3

_CLASS = np.zeros(256, np.uint8)
_BLANK, _LETTER, _UPPER, _DIGIT, _MARK, _BAR, _CALL, _SYMBOL = range(1, 9)
_CLASS[[0x20, *range(0x09, 0x0E)]] = _BLANK
_CLASS[list(range(0x61, 0x7B)) + list(range(0x80, 0x100))] = _LETTER
_CLASS[list(range(0x41, 0x5B))] = _UPPER
_CLASS[list(range(0x30, 0x3A))] = _DIGIT
_CLASS[[ord(c) for c in ".,;:?'\"()-"]] = _MARK
_CLASS[ord("|")] = _BAR
_CLASS[ord("!")] = _CALL
_CLASS[[ord(c) for c in "#$%&*+/<=>@[\\]^_`{}~"]] = _SYMBOL

# upper limits of the bins of each measure of a line
MEASURES = {
    "bytes": (1, 20, 60, 200, 1000),
    "words": (1, 2, 4, 10, 30),
    "word length": (3, 4, 5, 6, 8, 12),
    "upper case": (0.001, 0.03, 0.08, 0.2, 0.5),
    "digits": (0.001, 0.02, 0.1, 0.3),
    "marks": (0.001, 0.01, 0.02, 0.04, 0.08),
    "bars": (0.001, 0.01, 0.05),
    "calls": (0.001, 0.01, 0.05),
    "symbols": (0.001, 0.01, 0.05, 0.15),
    "word again": (0.001, 0.05, 0.2, 0.5),
    "line again": (0.5,),
    "first": (1, 2, 3, 4, 5, 6, 7, 8),
    "last": (1, 2, 3, 4, 5, 6, 7, 8),
    "lines of the text": (2, 3, 5, 9, 17, 65),
    "bytes of the text": (1, 50, 150, 400, 1000, 4000, 20000),
}
_SIZES = np.array([len(v) + 1 for v in MEASURES.values()])
_OFFSETS = np.cumsum(_SIZES) - _SIZES
_BINS = int(_SIZES.sum())
# measures of the text are the same for all its lines
_NEIGHBOUR = [i for i, name in enumerate(MEASURES) if not name.endswith("of the text")]
# bins of the line, the line before and the line after, and two for no such line
FEATURES = 3 * _BINS + 2


def line_measures(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bins of each line (lines by measures), byte lengths of the lines, and number of lines of each text."""
    size = len(data)
    breaks = np.flatnonzero(data == 0x0A)
    per_text = np.searchsorted(breaks, offsets[1:]) - np.searchsorted(breaks, offsets[:-1]) + 1
    text = np.repeat(np.arange(len(per_text)), per_text)
    heads = np.cumsum(per_text) - per_text
    starts = np.empty(len(text), np.int64)
    inner = np.ones(len(text), bool)
    inner[heads] = False
    starts[heads] = offsets[:-1]
    starts[inner] = breaks + 1
    ends = np.empty(len(text), np.int64)
    tail = np.zeros(len(text), bool)
    tail[heads + per_text - 1] = True
    ends[tail] = offsets[1:]
    ends[~tail] = breaks
    length = ends - starts

    kind = _CLASS[data]

    def count(mask: np.ndarray) -> np.ndarray:
        running = np.zeros(size + 1, np.int32)
        np.cumsum(mask, out=running[1:], dtype=np.int32)
        return (running[ends] - running[starts]).astype(np.float64)

    inside = kind != _BLANK
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    own = offsets[:-1][offsets[:-1] < size]
    opens[own] = inside[own]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    before = own[own > 0] - 1
    closes[before] = inside[before]
    word_start = np.flatnonzero(opens)
    word_length = np.flatnonzero(closes) + 1 - word_start
    words, word_bytes = count(opens), count(inside)
    hashed = run_sums(data[inside], word_length)
    again = np.zeros(size, bool)
    same = np.flatnonzero(hashed[1:] == hashed[:-1]) + 1
    # only a repeat of a word of the same line counts
    line_of = np.searchsorted(starts, word_start, "right")
    again[word_start[same[line_of[same] == line_of[same - 1]]]] = True

    filled = length > 0
    line_hash = np.zeros(len(text), np.uint64)
    line_hash[filled] = run_sums(data[data != 0x0A], length[filled])
    order = np.lexsort((line_hash, text))
    equal = (line_hash[order][1:] == line_hash[order][:-1]) & (text[order][1:] == text[order][:-1])
    repeated = np.zeros(len(text), bool)
    repeated[order[1:]] |= equal
    repeated[order[:-1]] |= equal

    whole = np.maximum(length, 1)
    edge = np.append(kind, 0)
    columns = {
        "bytes": length,
        "words": words,
        "word length": word_bytes / np.maximum(words, 1),
        "upper case": count(kind == _UPPER) / np.maximum(count((kind == _UPPER) | (kind == _LETTER)), 1),
        "digits": count(kind == _DIGIT) / whole,
        "marks": count(kind == _MARK) / whole,
        "bars": count(kind == _BAR) / whole,
        "calls": count(kind == _CALL) / whole,
        "symbols": count(kind == _SYMBOL) / whole,
        "word again": count(again) / np.maximum(words, 1),
        "line again": repeated & filled,
        "first": np.where(filled, edge[np.minimum(starts, size)], 0),
        "last": np.where(filled, edge[np.maximum(ends - 1, 0)], 0),
        "lines of the text": np.repeat(per_text, per_text),
        "bytes of the text": np.repeat(np.diff(offsets), per_text),
    }
    bins = np.stack([np.digitize(columns[name], limits) for name, limits in MEASURES.items()], axis=1)
    return bins.astype(np.uint8), length, per_text


def features(bins: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    """Numbers of the features of each line: its own bins, those of its neighbours, or that there is none."""
    own = bins.astype(np.int32) + _OFFSETS.astype(np.int32)
    near = own[:, _NEIGHBOUR]
    heads = np.cumsum(per_text) - per_text
    tails = heads + per_text - 1
    before = np.empty_like(near)
    before[1:] = near[:-1] + _BINS
    before[heads] = 3 * _BINS
    after = np.empty_like(near)
    after[:-1] = near[1:] + 2 * _BINS
    after[tails] = 3 * _BINS + 1
    return np.concatenate([own, before, after], axis=1)


def steps(scores: np.ndarray, moves: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Matrices of the lines: from the label before (rows) to the label of the line, good or bad.

    ``scores`` are those of bad against good, ``moves`` those of label pairs; ``first``: where texts start.
    """
    own = np.zeros((len(scores), 2))
    own[:, 1] = np.clip(scores, -300, 300)
    matrix = own[:, None, :] + moves
    matrix[first] = own[first][:, None, :]
    return np.exp(matrix - matrix.max(axis=(1, 2), keepdims=True))


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.empty_like(b)
    for i in (0, 1):
        for j in (0, 1):
            out[:, i, j] = a[:, i, 0] * b[:, 0, j] + a[:, i, 1] * b[:, 1, j]
    return out / np.maximum(out.max(axis=(1, 2), keepdims=True), 1e-300)


def passes(matrix: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward vectors of the lines, each up to a factor; ``longest``: most lines of a text."""
    ahead, behind = matrix.copy(), matrix.copy()
    width = 1
    while width < longest:
        ahead[width:] = _times(ahead[:-width], ahead[width:])
        behind[:-width] = _times(behind[:-width], behind[width:])
        width *= 2
    forward = ahead.sum(axis=1)
    backward = np.ones_like(forward)
    backward[:-1] = behind[1:].sum(axis=2)
    for vector in (forward, backward):
        vector /= np.maximum(vector.max(axis=1, keepdims=True), 1e-300)
    return forward, backward


def bad_lines(scores: np.ndarray, moves: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    """Probability of each line of being bad."""
    first = np.cumsum(per_text) - per_text
    forward, backward = passes(steps(scores, moves, first), int(per_text.max(initial=1)))
    both = forward * backward
    # no backward vector crosses the end of a text: the next one starts with equal rows
    return both[:, 1] / both.sum(axis=1)


def weighted_mean(bad: np.ndarray, length: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    """Share of bad lines in each text by their length; a line counts one byte more than it has."""
    first, weight = np.cumsum(per_text) - per_text, length + 1.0
    return np.add.reduceat(bad * weight, first) / np.add.reduceat(weight, first)


def _logit(mean: np.ndarray) -> np.ndarray:
    return np.log((mean + MARGIN) / (1 - mean + MARGIN))


def fit_chain(found: np.ndarray, labels: np.ndarray, per_text: np.ndarray, chained: bool, start=None):
    """Weights of the features and of label pairs, by maximum likelihood with a Gaussian prior."""
    n, first = len(labels), np.cumsum(per_text) - per_text
    longest = int(per_text.max())
    inner = np.ones(n, bool)
    inner[first] = False
    before = np.zeros(n, np.int64)
    before[1:] = labels[:-1]
    every = np.arange(n)
    flat = found.ravel()

    def loss(x):
        w, moves = x[:FEATURES], x[FEATURES:].reshape(2, 2)
        scores = w[found].sum(axis=1)
        if chained:
            matrix = steps(scores, moves, first)
            forward, backward = passes(matrix, longest)
            # probability of each label given the one before
            onward = matrix * backward[:, None, :]
            onward /= onward.sum(axis=2, keepdims=True)
            value = -np.log(np.maximum(onward[every, before, labels], 1e-300)).sum()
            pairs = np.empty((n, 2, 2))
            pairs[1:] = forward[:-1, :, None] * matrix[1:] * backward[1:, None, :]
            pairs[first] = 0
            total = pairs.sum(axis=(1, 2), keepdims=True)
            expected = (pairs / np.where(total > 0, total, 1)).sum(axis=0)
            both = forward * backward
            bad = both[:, 1] / both.sum(axis=1)
            np.add.at(expected, (before[inner], labels[inner]), -1)
        else:
            value = np.logaddexp(0, scores).sum() - scores[labels == 1].sum()
            bad, expected = 1 / (1 + np.exp(-np.clip(scores, -500, 500))), np.zeros((2, 2))
        error = bad - labels
        grad = np.bincount(flat, np.repeat(error, found.shape[1]), FEATURES)
        value += PENALTY / 2 * (x @ x)
        return value / n, (np.concatenate([grad, expected.ravel()]) + PENALTY * x) / n

    x = minimise(loss, np.zeros(FEATURES + 4) if start is None else start, STEPS)
    return x[:FEATURES], x[FEATURES:].reshape(2, 2)


def _fit_curve(z: np.ndarray, bad: np.ndarray) -> tuple[float, float]:
    def loss(x):
        margin = x[0] + x[1] * z
        p = 1 / (1 + np.exp(-margin))
        value = np.logaddexp(0, margin).sum() - (bad * margin).sum() + 0.5 * (x @ x)
        return value, np.array([(p - bad).sum(), ((p - bad) * z).sum()]) + x

    return tuple(minimise(loss, np.zeros(2), STEPS).tolist())


def fit(bins: np.ndarray, length: np.ndarray, per_text: np.ndarray, bad: np.ndarray):
    """Weights, moves and curve from the lines of texts that are bad (1) or good (0).

    With one kind of texts only, every text gets the share of good ones; without any, 0.5.
    """
    share = (bad.sum() + 0.5) / (len(bad) + 1)
    none = np.zeros(FEATURES), np.zeros((2, 2)), (float(np.log(share / (1 - share))), 0.0)
    if not len(bad) or bad.all() or not bad.any():
        return none
    found, lines = features(bins, per_text), np.repeat(bad, per_text).astype(np.int64)
    weights, _ = fit_chain(found, lines, per_text, chained=False)
    scores = weights[found].sum(axis=1)
    first = np.cumsum(per_text) - per_text
    worst = np.repeat(np.maximum.reduceat(scores, first), per_text)
    lines &= (scores > 0) | (scores == worst)
    weights, moves = fit_chain(found, lines, per_text, True, np.append(weights, np.zeros(4)))
    mean = weighted_mean(bad_lines(weights[found].sum(axis=1), moves, per_text), length, per_text)
    return weights, moves, _fit_curve(_logit(mean), bad.astype(np.float64))


def quality(bins: np.ndarray, length: np.ndarray, per_text: np.ndarray, model) -> np.ndarray:
    """Probability of each text of being good."""
    weights, moves, (a, b) = model
    scores = weights[features(bins, per_text)].sum(axis=1)
    mean = weighted_mean(bad_lines(scores, moves, per_text), length, per_text)
    return 1 / (1 + np.exp(np.clip(a + b * _logit(mean), -500, 500)))


def measured(text: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``line_measures`` of runs of texts of a few megabytes. No nulls."""
    for part in slices(pa.RecordBatch.from_arrays([text], ["text"]), "text", SLICE):
        yield line_measures(*joined_bytes(part))


def _lines_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        done = 0
        for bins, length, per_text in measured(batch.column(0)):
            ends = np.cumsum(per_text)
            parts = list(zip((ends - per_text).tolist(), ends.tolist()))
            own = batch.slice(done, len(parts))
            done += len(parts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([bins[a:b].tobytes() for a, b in parts], pa.binary()),
                    pa.array([length[a:b].tobytes() for a, b in parts], pa.binary()),
                    own.column(1),
                    own.column(2),
                ],
                ["bins", "lengths", "label", "place"],
            )


def _fit_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bins, lengths, labels, lines = [], [], [], 0
    for batch in batches:
        for b, n, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            if lines + len(n) // 8 <= TRAIN_LINES:
                lines += len(n) // 8
                bins.append(np.frombuffer(b, np.uint8).reshape(-1, len(MEASURES)))
                lengths.append(np.frombuffer(n, np.int64))
                labels.append(label)
    per_text = np.array([len(n) for n in lengths], np.int64)
    if labels:
        model = fit(np.concatenate(bins), np.concatenate(lengths), per_text, 1 - np.array(labels))
    else:
        model = fit(np.zeros((0, len(MEASURES)), np.uint8), per_text, per_text, np.zeros(0, np.int64))
    weights, moves, curve = model
    packed = np.concatenate([weights, moves.ravel(), curve])
    yield pa.RecordBatch.from_arrays([pa.array([packed.tolist()], pa.list_(pa.float64()))], ["model"])


def train(docs: DataFrame, labels: DataFrame, use: Column, train_rows: int = TRAIN_ROWS):
    """The fitted model. ``use``: condition on ``doc_id`` of the labels that may be learned.

    A document with several labels is good if all of them say so; rows whose label or id is
    null are not used.
    """
    own = labels.where(use & F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", "quality")
    most = max(own.count() / train_rows, 1.0)
    draw = F.pmod(F.xxhash64("doc_id", F.lit(12)), F.lit(1 << 30))
    sample = own.where(draw < int((1 << 30) / most)).groupBy("doc_id").agg(F.min("quality").alias("label"))
    # about train_rows rows of two numbers
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(sample), "doc_id")
    rows = rows.select("text", F.col("label").cast("int").alias("label"), F.xxhash64("doc_id", "text").alias("place"))
    lines = rows.mapInArrow(_lines_task, "bins binary, lengths binary, label int, place bigint")
    one = lines.repartition(1).sortWithinPartitions("place", "lengths")
    fitted = one.mapInArrow(_fit_task, "model array<double>").first()
    if fitted is None:
        return np.zeros(FEATURES), np.zeros((2, 2)), (0.0, 0.0)
    packed = np.array(fitted["model"])
    return packed[:FEATURES], packed[FEATURES : FEATURES + 4].reshape(2, 2), (float(packed[-2]), float(packed[-1]))


def scored(docs: DataFrame, labels: DataFrame, name: str = "score", folds: int = 3, fold: int = 1) -> DataFrame:
    """Add the probability that each text is of good quality.

    ``docs`` needs ``doc_id`` and ``text``, ``labels`` needs ``doc_id`` and ``quality``; other
    columns are neither read for the score nor lost, but one called ``name`` is replaced.
    Labels whose ids are in fold ``fold`` of ``folds`` are not learned. A null or empty
    text is one empty line and is scored as such; repeated rows get equal scores. With labels of one
    kind all scores are the share of good texts, without any label 0.5.
    """
    model = train(docs, labels, fold_of(F.col("doc_id"), folds) != fold)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        filled = text.fill_null("")
        return pa.array(np.concatenate([np.zeros(0), *(quality(*part, sent.value) for part in measured(filled))]), pa.float64())

    return docs.withColumn(name, score(F.col("text")))
