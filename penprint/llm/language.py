"""Language of a text by unigrams of pieces, summed over all segmentations.

The pieces are those of a public tokenizer file. Each language has a probability for
each piece. A word's probability is the sum, over all ways to cut it into pieces, of the
products of their probabilities; a forward pass over its letters gives it. A text's
probability is that of its words, and the share of the languages in the training rows is
the prior. Expectation maximisation fits the probabilities.

A letter outside the vocabulary has the same small share in all languages, so such letters
do not decide between them. Sums are rescaled on the way, so a word may be of any length.

Fitting reads a bounded sample: about ``TRAIN_ROWS`` rows over all languages, evenly,
chosen by a hash of the id, of which the tasks send the counts of words of up to ``STRETCH``
letters. Prediction reads every text where it lies, whole; words met before in a task are looked up.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

PIECES = "/opt/tokenizers/piece_bpe_32k.model"
TRAIN_ROWS = 6_000
ROUNDS = 3
SMOOTH = 0.05
# share of all letters outside the vocabulary
UNKNOWN_SHARE = 1e-7
# longer words are not learned, and are scored one by one
STRETCH = 48
# letters after which sums are rescaled
_RESCALE = 8
MARK = "▁"
UNKNOWN = "und"
_KEPT_WORDS = 400_000
_BLOCK_WORDS = 50_000
_LETTERS = re.compile(r"[^\W\d_]+")


def load_pieces(path: str = PIECES) -> dict[str, int]:
    """Pieces that are text, in lower case, with numbers from 1; 0 is for any other single letter."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = {
        model.id_to_piece(i).lower()
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
    }
    return {piece: k for k, piece in enumerate(sorted(texts), 1)}


def letter_words(text: str | None) -> list[str]:
    """Runs of letters in lower case."""
    return _LETTERS.findall(text.lower()) if text else []


def has_letter(words: list[str]) -> bool:
    return any(any(c.isalpha() for c in w) for w in words)


class Lattice:
    """All pieces in some words of equal length: ``number[w, i, k]`` is that of letters i to i + k + 1, or -1."""

    def __init__(self, words: list[str], pieces: dict[str, int], longest: int):
        marked = [MARK + w for w in words]
        self.length = len(marked[0])
        self.widest = min(longest, self.length)
        get, flat = pieces.get, []
        for w in marked:
            for i in range(self.length):
                own = [get(w[i:j], -1) for j in range(i + 1, min(i + self.widest, self.length) + 1)]
                if own[0] < 0:
                    own[0] = 0
                own += [-1] * (self.widest - len(own))
                flat += own
        self.number = np.array(flat, np.int32).reshape(len(words), self.length, self.widest)

    def steps(self) -> Iterator[tuple[int, int, np.ndarray]]:
        """Start, end and numbers of the pieces, for all places where some word has one."""
        used = (self.number >= 0).any(0)
        for i in range(self.length):
            for k in range(min(self.widest, self.length - i)):
                if used[i, k]:
                    yield i, i + k + 1, self.number[:, i, k]


def forward(lattice: Lattice, table: np.ndarray) -> np.ndarray:
    """``out[i, w]``: probability of the first i letters of word w, by language. The table's last row is zero."""
    out = np.zeros((lattice.length + 1, len(lattice.number), table.shape[1]))
    out[0] = 1
    for i, j, number in lattice.steps():
        out[j] += out[i] * table[number]
    return out


def backward(lattice: Lattice, table: np.ndarray) -> np.ndarray:
    out = np.zeros((lattice.length + 1, len(lattice.number), table.shape[1]))
    out[-1] = 1
    for i, j, number in reversed(list(lattice.steps())):
        out[i] += table[number] * out[j]
    return out


def word_logs(lattice: Lattice, table: np.ndarray) -> np.ndarray:
    """Log probability of each word (rows) by language."""
    out = np.zeros((lattice.length + 1, len(lattice.number), table.shape[1]))
    logs, scaled = np.zeros(out.shape[1:]), 0
    out[0] = 1
    for i, j, number in lattice.steps():
        if i >= scaled + _RESCALE:
            # nothing reaches further than the widest piece yet
            scaled, factor = i, out[i].copy()
            out[i : i + lattice.widest] /= factor
            logs += np.log(factor)
        out[j] += out[i] * table[number]
    return logs + np.log(out[-1])


def long_word_log(word: str, pieces: dict[str, int], longest: int, table: np.ndarray) -> np.ndarray:
    """Log probability of one word by language, with no more kept than the widest piece needs."""
    marked, get = MARK + word, pieces.get
    size, logs = longest + 1, np.zeros(table.shape[1])
    ring = np.zeros((size, table.shape[1]))
    ring[0] = 1
    for i in range(len(marked)):
        here = ring[i % size].copy()
        if i % _RESCALE == 0:
            logs += np.log(here)
            ring /= here
            here[:] = 1
        ring[i % size] = 0
        for j in range(i + 1, min(i + longest, len(marked)) + 1):
            number = get(marked[i:j], 0 if j == i + 1 else -1)
            if number >= 0:
                ring[j % size] += here * table[number]
    return logs + np.log(ring[len(marked) % size])


def by_length(words: list[str]) -> Iterator[list[str]]:
    for _, same in groupby(sorted(words, key=len), key=len):
        same = list(same)
        for i in range(0, len(same), _BLOCK_WORDS):
            yield same[i : i + _BLOCK_WORDS]


def fit(counts: dict[str, Counter], pieces: dict[str, int], rounds: int = ROUNDS) -> np.ndarray:
    """Probabilities of all pieces (rows; the last is zero) for each language, from its word counts."""
    longest = max(map(len, pieces), default=1)
    size = len(pieces) + 1
    table = np.zeros((size + 1, len(counts)))
    for column, words in enumerate(counts.values()):
        own = np.full(size, 1 / size)
        lattices = [(Lattice(block, pieces, longest), np.array([words[w] for w in block], float)) for block in by_length(list(words))]
        for _ in range(rounds):
            now = np.append(own, 0)[:, None]
            expected = np.full(size, SMOOTH)
            for lattice, n in lattices:
                ahead, behind = forward(lattice, now)[:, :, 0], backward(lattice, now)[:, :, 0]
                share = n / ahead[-1]
                for i, j, number in lattice.steps():
                    weight = share * ahead[i] * now[number, 0] * behind[j]
                    expected += np.bincount(number, weight, size + 1)[:size] if number.min() >= 0 else np.bincount(
                        number[number >= 0], weight[number >= 0], size
                    )
            # all letters that no piece has count as little in every language
            expected[0] = 0
            own = expected / expected.sum() * (1 - UNKNOWN_SHARE)
            own[0] = UNKNOWN_SHARE
        table[:size, column] = own
    return table


class Scorer:
    """Logs of word probabilities, with those met before kept."""

    def __init__(self, pieces: dict[str, int], table: np.ndarray):
        self.pieces, self.table = pieces, table
        self.longest = max(map(len, pieces), default=1)
        self.place: dict[str, int] = {}
        self.logs = np.zeros((0, table.shape[1]))

    def texts(self, words: list[list[str]]) -> np.ndarray:
        """Log probability of each text by language."""
        if len(self.place) > _KEPT_WORDS:
            self.place, self.logs = {}, self.logs[:0]
        fresh = list({w for own in words for w in own} - self.place.keys())
        parts = [self.logs]
        known = len(self.place)
        for block in by_length([w for w in fresh if len(w) <= STRETCH]):
            parts.append(word_logs(Lattice(block, self.pieces, self.longest), self.table))
            for w in block:
                self.place[w] = known
                known += 1
        for w in fresh:
            if len(w) > STRETCH:
                parts.append(long_word_log(w, self.pieces, self.longest, self.table)[None])
                self.place[w] = known
                known += 1
        if len(parts) > 1:
            self.logs = np.concatenate(parts)
        get = self.place.__getitem__
        out = np.zeros((len(words), self.table.shape[1]))
        for i, own in enumerate(words):
            if own:
                out[i] = self.logs[np.fromiter(map(get, own), np.int64, len(own))].sum(0)
        return out


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def rows():
        langs, words = zip(*counts)
        return pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(words, pa.string()), pa.array(list(counts.values()), pa.int64())],
            ["lang", "word", "n"],
        )

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts.update((lang, w) for w in letter_words(text) if len(w) <= STRETCH)
            if len(counts) > _KEPT_WORDS:
                yield rows()
                counts.clear()
    if counts:
        yield rows()


def sample_words(rows: DataFrame) -> dict[str, Counter]:
    """Word counts by language of rows with ``lang`` and ``text``; languages and words in order."""
    part = rows.select("lang", "text").mapInArrow(_count_words, "lang string, word string, n bigint")
    counts: dict[str, Counter] = {}
    for lang, word, n in sorted(map(tuple, part.groupBy("lang", "word").agg(F.sum("n").alias("n")).collect())):
        counts.setdefault(lang, Counter())[word] = n
    return counts


def train(docs: DataFrame, use: Column, pieces: dict[str, int], train_rows: int = TRAIN_ROWS) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, their log shares, and the table of probabilities, from rows that meet ``use``."""
    own = docs.where(use & F.col("lang").isNotNull()).select("doc_id", "text", "lang")
    shares = {r.lang: r["count"] for r in own.groupBy("lang").count().collect()}
    if not shares:
        return [], np.zeros(0), np.zeros((len(pieces) + 2, 0))
    each = max(train_rows // len(shares), 1)
    least = F.lit(0)
    for lang, n in shares.items():
        least = F.when(F.col("lang") == lang, F.lit(int((1 << 30) * min(1.0, each / n)))).otherwise(least)
    draw = F.pmod(F.xxhash64(F.coalesce(F.col("doc_id"), F.lit(0)), F.lit(11)), F.lit(1 << 30))
    counts = sample_words(own.where(draw < least))
    langs = list(counts)
    logs = np.log(np.array([shares[x] for x in langs]) / sum(shares.values())) if langs else np.zeros(0)
    return langs, logs, fit(counts, pieces)


def predicted(docs: DataFrame, use: Column, name: str = "language", pieces_path: str = PIECES) -> DataFrame:
    """Add a struct ``name`` with the most probable language and its probability.

    ``docs`` needs ``doc_id``, ``text`` and ``lang``; ``lang`` is read only where ``use``
    (a condition on ``doc_id``) holds and it is not null. Null texts and texts without a
    letter get ``und`` and 0, as do all texts when nothing can be learned. All columns of
    ``docs`` are kept, but one called ``name`` is replaced.
    """
    pieces = load_pieces(pieces_path)
    langs, prior, table = train(docs, use, pieces)
    sent = docs.sparkSession.sparkContext.broadcast((pieces, langs, prior, table))

    @arrow_udf("struct<lang: string, score: double>")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pieces, langs, prior, table = sent.value
        scorer = Scorer(pieces, table)
        for text in batches:
            best, scores = [], []
            for start in range(0, len(text), 1000):
                words = [letter_words(t) for t in text.slice(start, 1000).to_pylist()]
                if langs:
                    logs = scorer.texts(words) + prior
                    odds = np.exp(logs - logs.max(1, keepdims=True))
                    top, share = odds.argmax(1), odds.max(1) / odds.sum(1)
                for i, own in enumerate(words):
                    known = bool(langs) and has_letter(own)
                    best.append(langs[top[i]] if known else UNKNOWN)
                    scores.append(float(share[i]) if known else 0.0)
            yield pa.StructArray.from_arrays([pa.array(best, pa.string()), pa.array(scores, pa.float64())], ["lang", "score"])

    return docs.withColumn(name, predict("text"))
