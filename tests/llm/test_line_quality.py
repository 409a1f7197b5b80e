"""The line field against sums over all labellings, its fit by finite differences, and held-out accuracy."""

import itertools
import math
import zlib

import numpy as np
import pyarrow as pa
import pytest

from penprint.llm import line_quality as lq
from penprint.llm import queries

TEXTS = [
    "", "one line", "\n", "a\n\nb\n", "Word word word\nWord word word", "!!! ###\n| a | b |", "é ü\tß\r\nnext " * 40,
    "x" * 100_000, "line\n" * 3000,
]


def plain_lines(text):
    """Counts of each line, one line and character at a time."""
    lines = text.encode().split(b"\n")
    out = []
    for line in lines:
        kinds = [int(lq._CLASS[c]) for c in line]
        words, word = [], b""
        for c, kind in [*zip(line, kinds), (0x20, lq._BLANK)]:
            if kind == lq._BLANK:
                if word:
                    words.append(word)
                word = b""
            else:
                word += bytes([c])
        share = lambda k: kinds.count(k) / max(len(line), 1)
        letters = kinds.count(lq._LETTER) + kinds.count(lq._UPPER)
        values = [
            len(line), len(words), sum(map(len, words)) / max(len(words), 1), kinds.count(lq._UPPER) / max(letters, 1),
            share(lq._DIGIT), share(lq._MARK), share(lq._BAR), share(lq._CALL), share(lq._SYMBOL),
            sum(a == b for a, b in zip(words, words[1:])) / max(len(words), 1), float(bool(line) and lines.count(line) > 1),
            kinds[0] if kinds else 0, kinds[-1] if kinds else 0, len(lines), len(text.encode()),
        ]
        out.append([int(np.digitize(v, limits)) for v, limits in zip(values, lq.MEASURES.values())])
    return out


def test_measures_of_lines():
    bins, length, per_text = lq.line_measures(*lq.joined_bytes(pa.record_batch([pa.array(TEXTS)], ["text"])))
    expected = [plain_lines(t) for t in TEXTS]
    assert per_text.tolist() == [len(x) for x in expected]
    assert bins.tolist() == [row for rows in expected for row in rows]
    assert length.tolist() == [len(x) for t in TEXTS for x in t.encode().split(b"\n")]


def log_weight(scores, moves, labels):
    pairs = sum(moves[a][b] for a, b in zip(labels, labels[1:]))
    return pairs + sum(s for s, b in zip(scores, labels) if b)


def test_marginals_are_sums_over_labellings():
    rng = np.random.default_rng(0)
    per_text = np.array([1, 5, 2, 7, 1, 3])
    scores, moves = rng.normal(0, 3, per_text.sum()), rng.normal(0, 2, (2, 2))
    got = lq.bad_lines(scores, moves, per_text)
    start = 0
    for n in per_text:
        own = scores[start : start + n]
        weights = {y: math.exp(log_weight(own, moves, y)) for y in itertools.product((0, 1), repeat=int(n))}
        total = sum(weights.values())
        for t in range(n):
            assert math.isclose(got[start + t], sum(w for y, w in weights.items() if y[t]) / total, rel_tol=1e-9)
        start += n


def test_long_chains_stay_finite():
    per_text = np.array([200_000, 1])
    got = lq.bad_lines(np.tile([900.0, -900.0, 5.0], 66_667), np.array([[30.0, -30.0], [-30.0, 30.0]]), per_text)
    assert np.isfinite(got).all() and ((got >= 0) & (got <= 1)).all()


def test_fit_follows_the_likelihood(monkeypatch):
    seen = {}

    def spy(loss, x, steps):
        seen["loss"] = loss
        return x

    monkeypatch.setattr(lq, "minimise", spy)
    texts = ["good line\nx | y\ngood", "one", "bad!!\nbad!!\nfine", "a\nb\nc d"]
    bins, _, per_text = lq.line_measures(*lq.joined_bytes(pa.record_batch([pa.array(texts)], ["text"])))
    found, labels = lq.features(bins, per_text), np.array([0, 1, 0, 0, 1, 1, 0, 1, 0, 1])
    lq.fit_chain(found, labels, per_text, True)
    x = np.random.default_rng(1).normal(0, 0.3, lq.FEATURES + 4)
    value, grad = seen["loss"](x)
    scores, moves = x[: lq.FEATURES][found].sum(axis=1), x[lq.FEATURES :].reshape(2, 2)
    expected, start = lq.PENALTY / 2 * (x @ x), 0
    for n in per_text:
        own = scores[start : start + n]
        total = sum(math.exp(log_weight(own, moves, y)) for y in itertools.product((0, 1), repeat=int(n)))
        expected += math.log(total) - log_weight(own, moves, labels[start : start + n].tolist())
        start += n
    assert math.isclose(value, expected / len(labels), rel_tol=1e-9)
    for i in [*np.unique(found)[::7], *range(lq.FEATURES, lq.FEATURES + 4)]:
        step = np.zeros(len(x))
        step[i] = 1e-5
        slope = (seen["loss"](x + step)[0] - seen["loss"](x - step)[0]) / 2e-5
        assert math.isclose(grad[i], slope, abs_tol=1e-6)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = queries.op12_line_quality(spark, sf).collect()
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    tested = [(truth[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in truth]
    good, bad = [p for q, p in tested if q], [p for q, p in tested if not q]
    assert sum(good) / len(good) > 0.97 and sum(bad) / len(bad) < 0.2


@pytest.mark.parametrize("labels", [[], [(0, 1), (1, 1)], [(0, 0), (1, None)], [(1, 0), (3, 1), (4, 1), (None, 0), (3, 0)]])
def test_odd_rows(spark, labels):
    docs = [(i, t, "clash") for i, t in enumerate(TEXTS)] + [(None, None, "n"), (1, TEXTS[1], "again")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, score string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int")
    got = lq.scored(frame, marks).collect()
    assert len(got) == len(docs) and all(0 <= r.score <= 1 for r in got)
    by_text = {}
    assert all(by_text.setdefault(r.text or "", r.score) == pytest.approx(r.score) for r in got)
    assert lq.scored(frame.limit(0), marks).count() == 0
