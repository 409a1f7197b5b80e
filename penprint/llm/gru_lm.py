"""Scoring texts with a gated recurrent language model.

The model predicts a text word by word. Its output is factored by classes:
``P(word) = P(class | state) * P(word | class, state)``. The most frequent words
are in classes of equal size whose members have a softmax of their own. All other
words, known or not, are in a class by their last two letters; there a word has the
add-one share of its count in the class, and one share stands for all unknown words.
So probabilities sum to one over all training words and the unknown ones.

Training is truncated backpropagation: a window of words at a time, with the state
carried on to the next window of the same text. Scoring carries the state in the
same way, so a text is scored whole, whatever its length. Texts are turned into codes
once, and training and scoring read these.

All training texts are read: word counts come from a shuffle, and the network is
trained in rounds. In a round each task trains on its own texts from the common
start, and the weights of all tasks are averaged by words seen. The head of the
vocabulary (at most ``HEAD_WORDS`` words of at most ``HEAD_BYTES`` bytes, about
10 MB) is sent to the tasks; rarer words are looked up by a join.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from penprint.llm.common import slices, text_bytes
from penprint.session import staged

HEAD_WORDS = 131_072
HEAD_BYTES = 64
LEARNED = 512
CLASS_WORDS = 32
SHAPES = 48
HIDDEN = 16
LANES = 512
WINDOW = 32
SCORE_LANES = 1024
SCORE_WINDOW = 32
TRAIN_DOCS = 4096
SCORE_BYTES = 32 << 20
ENCODE_BYTES = 1 << 20
RATE = 0.01
# share of the training texts, in eighths, that each round reads; together all of them
ROUNDS = (1, 3, 4)
END = b""
_MOST_COUNTED = 400_000
_MARKS = bytes(range(33, 48)) + bytes(range(58, 65)) + bytes(range(91, 97)) + bytes(range(123, 127))


def tokens(text: bytes) -> list[bytes]:
    """Words of a text with A-Z in lower case, and the end."""
    words = text.lower().split()
    words.append(END)
    return words


def ending(word: bytes) -> bytes:
    """The last two bytes without closing marks: they tell what kind of word it is."""
    return word.rstrip(_MARKS)[-2:]


# --- counts -----------------------------------------------------------------


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counted: Counter = Counter()

    def rows():
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counted), pa.binary()), pa.array(list(counted.values()), pa.int64())],
            ["word", "n"],
        )

    for batch in batches:
        for text in text_bytes(batch):
            counted.update(tokens(text))
            if len(counted) > _MOST_COUNTED:
                yield rows()
                counted.clear()
    if counted:
        yield rows()


def word_counts(texts: DataFrame) -> DataFrame:
    """How often each token occurs in the column ``text``; the end is the empty word."""
    part = texts.select("text").mapInArrow(_count_batches, "word binary, n long")
    return part.groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """Totals, the frequent words, and the classes of all words."""

    total: int
    types: int
    least: int  # words with at least this count are in the head
    head: dict[bytes, int]  # word: its number
    count: np.ndarray  # of the head
    code: np.ndarray  # of the head: learned word, or LEARNED + its ending's class
    shapes: dict[bytes, int]
    shape_weight: np.ndarray  # counts plus types plus one, by ending class

    def shape(self, word: bytes) -> int:
        return self.shapes.get(ending(word), SHAPES - 1)


def _shape_totals(shapes: dict[bytes, int], learned: set[bytes]):
    def run(batches):
        n, types = np.zeros(SHAPES, np.int64), np.zeros(SHAPES, np.int64)
        for batch in batches:
            for word, count in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if word != END and word not in learned:
                    k = shapes.get(ending(word), SHAPES - 1)
                    n[k] += count
                    types[k] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(SHAPES)), pa.array(n), pa.array(types)], ["shape", "n", "types"]
        )

    return run


def vocabulary(counts: DataFrame, head_words: int = HEAD_WORDS) -> Vocabulary:
    """Totals and head of a written table of counts."""
    total, types = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    short = counts.where((F.length("word") <= HEAD_BYTES) & (F.length("word") > 0))
    # counts in sixteenths of a power of two: at most about a thousand steps
    step = F.floor(F.log2("n") * 16).cast("int").alias("step")
    steps = sorted(short.groupBy(step).count().collect(), reverse=True)
    lowest, words = None, 0
    for row in steps:
        words += row["count"]
        if words > head_words:
            break
        lowest = row.step
    rows = []
    if lowest is not None:
        rows = short.where(F.floor(F.log2("n") * 16) >= lowest).select("word", "n").collect()
    rows = sorted(((bytes(r.word), r.n) for r in rows), key=lambda r: (-r[1], r[0]))
    least = min((n for _, n in rows), default=1 << 62)

    mass: Counter = Counter()
    for word, n in rows[LEARNED:]:
        mass[ending(word)] += n
    best = sorted(mass, key=lambda e: (-mass[e], e))[: SHAPES - 1]
    shapes = {e: k for k, e in enumerate(best)}
    code = np.array(
        [i if i < LEARNED else LEARNED + shapes.get(ending(w), SHAPES - 1) for i, (w, _) in enumerate(rows)],
        np.int32,
    )
    per_shape = counts.mapInArrow(
        _shape_totals(shapes, {w for w, _ in rows[:LEARNED]}), "shape long, n long, types long"
    )
    weight = np.ones(SHAPES)
    for row in per_shape.groupBy("shape").agg(F.sum("n").alias("n"), F.sum("types").alias("t")).collect():
        weight[row.shape] += row.n + row.t
    return Vocabulary(
        total, types, least, {w: i for i, (w, _) in enumerate(rows)},
        np.array([n for _, n in rows], np.int64), code, shapes, weight,
    )


def end_count(counts: DataFrame) -> int:
    return counts.where(F.length("word") == 0).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


# --- network ----------------------------------------------------------------

_CODES = LEARNED + SHAPES + 1
_ENDING = _CODES - 1
_WORD_CLASSES = LEARNED // CLASS_WORDS
_CLASSES = _WORD_CLASSES + SHAPES + 1
# class of each code
_CLASS = np.concatenate(
    [np.arange(LEARNED) // CLASS_WORDS, np.arange(_WORD_CLASSES, _CLASSES)]
).astype(np.int64)


def shapes_of_weights(hidden: int = HIDDEN) -> dict[str, tuple[int, ...]]:
    return {
        "gates": (_CODES, 3 * hidden),  # of the word that was read last
        "carry": (hidden, 3 * hidden),  # of the state
        "classes": (hidden + 1, _CLASSES),
        "words": (_WORD_CLASSES, hidden + 1, CLASS_WORDS),
    }


def start_weights(vocab: Vocabulary, hidden: int = HIDDEN) -> dict[str, np.ndarray]:
    """Small random weights; the biases are the logs of the counted shares."""
    rng = np.random.default_rng(1)
    out = {k: (rng.standard_normal(s) * 0.1).astype(np.float32) for k, s in shapes_of_weights(hidden).items()}
    share = np.ones(_CLASSES)
    learned = np.ones(LEARNED)
    learned[: min(LEARNED, len(vocab.count))] += vocab.count[:LEARNED]
    share[:_WORD_CLASSES] += learned.reshape(_WORD_CLASSES, CLASS_WORDS).sum(1)
    share[_WORD_CLASSES:-1] += vocab.shape_weight
    out["classes"][-1] = np.log(share / share.sum())
    by_class = learned.reshape(_WORD_CLASSES, CLASS_WORDS)
    out["words"][:, -1] = np.log(by_class / by_class.sum(1, keepdims=True))
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def run_window(weights: dict, state: np.ndarray, read: np.ndarray, keep=None) -> tuple[np.ndarray, list]:
    """States after each word of a window. ``read``: words by step and lane.

    ``keep`` is 0 where a new text starts, so that its state starts at zero.
    """
    hidden = state.shape[1]
    gates = weights["gates"]
    steps, kept = read.shape[0], []
    states = np.empty((steps, *state.shape), np.float32)
    for t in range(steps):
        x = gates[read[t]]
        if keep is not None:
            state = state * keep[t]
        u = state @ weights["carry"]
        both = _sigmoid(x[:, : 2 * hidden] + u[:, : 2 * hidden])
        update, reset = both[:, :hidden], both[:, hidden:]
        fresh = np.tanh(x[:, 2 * hidden :] + reset * u[:, 2 * hidden :])
        kept.append((state, update, reset, fresh, u[:, 2 * hidden :]))
        state = fresh + update * (state - fresh)
        states[t] = state
    return states, kept


def _with_one(states: np.ndarray) -> np.ndarray:
    return np.concatenate([states, np.ones((len(states), 1), np.float32)], 1)


def _exps(logits: np.ndarray, column: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Exponentials of the rows up to a factor, in place, their sums, and the log share of one column of each row."""
    logits -= logits.max(1, keepdims=True)
    own = logits[np.arange(len(logits)), column]
    np.exp(logits, out=logits)
    sums = logits.sum(1)
    return logits, sums, own - np.log(sums)


def word_log_probs(weights: dict, states: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Natural log of P(class) * P(learned word | class) for each state and its target code."""
    one = _with_one(states)
    out = _exps(one @ weights["classes"], _CLASS[target])[2].astype(np.float64)
    for k, at in _by_class(target):
        out[at] += _exps(one[at] @ weights["words"][k], target[at] % CLASS_WORDS)[2]
    return out


def _by_class(target: np.ndarray):
    """Rows whose target is a learned word, class by class."""
    at = np.flatnonzero(target < LEARNED)
    classes = (target[at] // CLASS_WORDS).astype(np.int16)
    order = np.argsort(classes, kind="stable")
    at, classes = at[order], classes[order]
    edges = np.searchsorted(classes, np.arange(_WORD_CLASSES + 1))
    for k in range(_WORD_CLASSES):
        if edges[k] < edges[k + 1]:
            yield k, at[edges[k] : edges[k + 1]]


def gradients(weights: dict, state, read, target, live, keep):
    """Gradients of the mean loss of one window; the state that the next window starts with; the loss."""
    hidden = state.shape[1]
    steps, lanes = read.shape
    states, kept = run_window(weights, state, read, keep)
    flat = states.reshape(-1, hidden)
    use = np.flatnonzero(live.reshape(-1))
    goal = target.reshape(-1)[use]
    one = _with_one(flat[use])
    scale = np.float32(1 / max(len(use), 1))
    out = {k: np.zeros_like(v) for k, v in weights.items()}
    error, sums, log_p = _exps(one @ weights["classes"], _CLASS[goal])
    loss = -log_p.sum(dtype=np.float64)
    error *= (scale / sums)[:, None]
    error[np.arange(len(use)), _CLASS[goal]] -= scale
    out["classes"] = one.T @ error
    back = error @ weights["classes"][:-1].T
    for k, at in _by_class(goal):
        own, column = one[at], goal[at] % CLASS_WORDS
        error, sums, log_p = _exps(own @ weights["words"][k], column)
        loss -= log_p.sum(dtype=np.float64)
        error *= (scale / sums)[:, None]
        error[np.arange(len(at)), column] -= scale
        out["words"][k] = own.T @ error
        back[at] += error @ weights["words"][k][:-1].T
    to_state = np.zeros((steps * lanes, hidden), np.float32)
    to_state[use] = back
    to_state = to_state.reshape(steps, lanes, hidden)

    carried = np.zeros((lanes, hidden), np.float32)
    at_gates = np.empty((steps, lanes, 3 * hidden), np.float32)
    for t in range(steps - 1, -1, -1):
        before, update, reset, fresh, u_fresh = kept[t]
        g = to_state[t] + carried
        d_fresh = g * (1 - update) * (1 - fresh * fresh)
        d_update = g * (before - fresh) * update * (1 - update)
        d_reset = d_fresh * u_fresh * reset * (1 - reset)
        x = at_gates[t]
        x[:, :hidden], x[:, hidden : 2 * hidden], x[:, 2 * hidden :] = d_update, d_reset, d_fresh
        d_u = x.copy()
        d_u[:, 2 * hidden :] *= reset
        out["carry"] += before.T @ d_u
        carried = (g * update + d_u @ weights["carry"].T) * keep[t]
    words = read.reshape(-1)
    # codes are small, and short integers are sorted in linear time
    order = np.argsort(words.astype(np.int16), kind="stable")
    ordered = words[order]
    starts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    out["gates"][ordered[starts]] = np.add.reduceat(at_gates.reshape(-1, 3 * hidden)[order], starts)
    return out, states[-1], loss


class Trainer:
    """Adam steps on windows of texts that stand one after the other in lanes."""

    def __init__(self, weights: dict, rate: float = RATE):
        self.weights = {k: v.copy() for k, v in weights.items()}
        self.rate, self.steps, self.seen, self.loss = rate, 0, 0, 0.0
        self.first = {k: np.zeros_like(v) for k, v in weights.items()}
        self.second = {k: np.zeros_like(v) for k, v in weights.items()}

    def texts(self, codes: list[np.ndarray]) -> None:
        """One pass over some texts, dealt evenly to the lanes."""
        target, read, starts = stream(codes)
        lanes = min(LANES, max(len(target) // WINDOW, 1))
        length = -(-len(target) // lanes)
        live = np.ones(len(target), bool)
        pad = lanes * length - len(target)

        def by_lane(x):
            return np.pad(x, (0, pad)).reshape(lanes, length).T

        target, read, live = by_lane(target), by_lane(read), by_lane(live)
        keep = (~by_lane(starts)).astype(np.float32)[:, :, None]
        state = np.zeros((lanes, self.weights["carry"].shape[0]), np.float32)
        for t in range(0, length, WINDOW):
            w = slice(t, t + WINDOW)
            grads, state, loss = gradients(self.weights, state, read[w], target[w], live[w], keep[w])
            self.seen += int(live[w].sum())
            self.loss += loss
            self._step(grads)

    def _step(self, grads: dict) -> None:
        self.steps += 1
        norm = math.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        shrink = np.float32(min(1.0, 1.0 / (norm + 1e-8)))
        rate = self.rate * math.sqrt(1 - 0.99**self.steps) / (1 - 0.9**self.steps)
        for k, g in grads.items():
            g *= shrink
            m, v = self.first[k], self.second[k]
            m += np.float32(0.1) * (g - m)
            v += np.float32(0.01) * (g * g - v)
            self.weights[k] -= np.float32(rate) * m / (np.sqrt(v) + np.float32(1e-8))


def stream(codes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts one after the other: target words, the words read before them, and where texts start.

    A text starts after an end.
    """
    target = np.concatenate(codes).astype(np.int64)
    lengths = np.array([len(c) for c in codes])
    starts = np.zeros(len(target), bool)
    starts[np.cumsum(lengths) - lengths] = True
    read = np.empty_like(target)
    read[1:] = target[:-1]
    read[starts] = _ENDING
    return target, read, starts


def windows(codes: list[np.ndarray], width: int):
    """Windows over texts sorted by falling length, a text a lane: read, target and mask."""
    flat, before, _ = stream(codes)
    lengths = np.array([len(c) for c in codes])
    first = np.cumsum(lengths) - lengths
    for start in range(0, int(lengths[0]), width):
        lanes = int((lengths > start).sum())
        steps = min(width, int(lengths[0]) - start)
        place = start + np.arange(steps)[:, None]
        live = place < lengths[None, :lanes]
        at = first[None, :lanes] + np.minimum(place, lengths[None, :lanes] - 1)
        yield before[at], flat[at], live


def encoder(vocab: Vocabulary):
    """Function from the words of texts that follow each other to head numbers (-1: not in the head), codes, and places of rare words."""
    get, code = vocab.head.get, vocab.code
    shapes: dict[bytes, int] = {}

    def shape(word: bytes) -> int:
        # words of equal last bytes end alike, unless they are all marks
        last = word[-4:]
        found = shapes.get(last)
        if found is None:
            found = vocab.shape(word)
            if len(word) > 4 and last.rstrip(_MARKS)[1:] and len(shapes) < _MOST_COUNTED:
                shapes[last] = found
        return found

    def encode(words: list[bytes], ends: np.ndarray):
        numbers = np.fromiter(map(get, words, repeat(-1)), np.int32, len(words))
        codes = code[numbers] if len(code) else np.zeros(len(words), np.int32)
        unknown = numbers < 0
        unknown[ends] = False
        rare = np.flatnonzero(unknown)
        codes[rare] = [LEARNED + shape(words[i]) for i in rare.tolist()]
        codes[ends] = _ENDING
        return numbers, codes, rare

    return encode


def grouped(lengths: np.ndarray) -> Iterator[np.ndarray]:
    """Row numbers of texts in groups of similar length, longest first."""
    order = np.argsort(-lengths, kind="stable")
    for i in range(0, len(order), SCORE_LANES):
        yield order[i : i + SCORE_LANES]


_ENCODED = (
    "row long, doc_id long, held_out boolean, n_tokens long, known long, log_counts double, extra double, "
    "rare array<struct<word: binary, n: int>>, codes binary"
)


def _encode_task(vocab, ends: int):
    """Codes of the texts, and all of their scores that does not need the network."""

    def run(batches):
        v = Vocabulary(**vocab.value)
        encode = encoder(v)
        log_count = np.log10(v.count + 1.0) if len(v.count) else np.zeros(1)
        in_shape = v.code >= LEARNED
        shape_log = np.log10(v.shape_weight)
        end_log = math.log10(ends + 1)
        for batch in batches:
            for part in slices(batch, "text", ENCODE_BYTES):
                words, lengths = [], []
                for text in text_bytes(part):
                    own = tokens(text)
                    lengths.append(len(own))
                    words += own
                stops = np.cumsum(lengths)
                firsts = stops - lengths
                numbers, codes, rare = encode(words, stops - 1)
                known = numbers >= 0
                logs = np.where(known, log_count[numbers], 0)
                shaped = np.where(known & in_shape[numbers], logs, 0) if len(in_shape) else np.zeros(len(words))
                of_shape = (codes >= LEARNED) & (codes < _ENDING)
                shaped[of_shape] -= shape_log[codes[of_shape] - LEARNED]
                # each text ends with a token, so no sum is of nothing
                summed = [np.add.reduceat(x, firsts) for x in (known.astype(np.int64), logs, shaped)]
                texts = np.searchsorted(stops, rare, "right").tolist()
                found = Counter(zip(texts, map(words.__getitem__, rare.tolist())))
                per_text = np.zeros(len(lengths) + 1, np.int32)
                order = sorted(found, key=lambda pair: pair[0])
                np.add.at(per_text, np.array([t + 1 for t, _ in order], np.int64), 1)
                pairs = pa.StructArray.from_arrays(
                    [pa.array([w for _, w in order], pa.binary()), pa.array([found[k] for k in order], pa.int32())], ["word", "n"]
                )
                flat = codes.astype(np.int16)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), part.column(1), part.column(2), pa.array(lengths, pa.int64()),
                        pa.array(summed[0] + (ends > 0)), pa.array(summed[1] + end_log), pa.array(summed[2]),
                        pa.ListArray.from_arrays(pa.array(np.cumsum(per_text, dtype=np.int32)), pairs),
                        pa.array([flat[a:b].tobytes() for a, b in zip(firsts.tolist(), stops.tolist())], pa.binary()),
                    ],
                    ["row", "doc_id", "held_out", "n_tokens", "known", "log_counts", "extra", "rare", "codes"],
                )

    return run


def _codes(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [np.frombuffer(c, np.int16) for c in text_bytes(batch, "codes")]


def _train_task(weights):
    def run(batches):
        trainer = Trainer(weights.value)
        for batch in batches:
            for start in range(0, batch.num_rows, TRAIN_DOCS):
                for part in slices(batch.slice(start, TRAIN_DOCS), "codes", SCORE_BYTES):
                    trainer.texts(_codes(part))
        if trainer.seen:
            flat = np.concatenate([v.reshape(-1) for v in trainer.weights.values()]).astype(np.float64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(flat))), pa.array(flat * trainer.seen), pa.array(np.full(len(flat), trainer.seen))],
                ["at", "weighted", "seen"],
            )

    return run


def train(texts: DataFrame, key: Column, start: dict, rounds=ROUNDS) -> dict:
    """Weights after all rounds over the ``codes`` of texts."""
    spark = texts.sparkSession
    weights, low = start, 0
    slot = F.pmod(F.xxhash64(key), F.lit(sum(rounds)))
    for share in rounds:
        sent = spark.sparkContext.broadcast(weights)
        part = texts.where((slot >= low) & (slot < low + share)).select("codes")
        sums = part.mapInArrow(_train_task(sent), "at long, weighted double, seen long")
        rows = sums.groupBy("at").agg((F.sum("weighted") / F.sum("seen")).alias("w")).collect()
        low += share
        if rows:
            flat = np.empty(len(rows))
            flat[[r["at"] for r in rows]] = [r.w for r in rows]
            out, used = {}, 0
            for k, v in weights.items():
                out[k] = flat[used : used + v.size].reshape(v.shape).astype(np.float32)
                used += v.size
            weights = out
        sent.unpersist()
    return weights


# --- scores -----------------------------------------------------------------

def score_codes(weights: dict, codes: list[np.ndarray]) -> np.ndarray:
    """Natural log of P(class) * P(learned word | class) of whole texts."""
    out = np.zeros(len(codes))
    hidden = weights["carry"].shape[0]
    for group in grouped(np.array([len(c) for c in codes])):
        own = [codes[i] for i in group]
        state = np.zeros((len(own), hidden), np.float32)
        for read, target, live in windows(own, SCORE_WINDOW):
            states, _ = run_window(weights, state[: read.shape[1]], read)
            state = states[-1]
            use = np.flatnonzero(live.reshape(-1))
            log_p = word_log_probs(weights, states.reshape(-1, hidden)[use], target.reshape(-1)[use])
            out[group[: read.shape[1]]] += np.bincount(use % read.shape[1], log_p, read.shape[1])
    return out


_KEPT = ("row", "doc_id", "held_out", "n_tokens", "known", "log_counts")
_SCORED = "row long, doc_id long, held_out boolean, n_tokens long, known long, log_counts double, model double"


def _score_task(weights):
    def run(batches):
        for batch in batches:
            for part in slices(batch, "codes", SCORE_BYTES):
                extra = part.column(part.schema.get_field_index("extra")).to_numpy()
                model = score_codes(weights.value, _codes(part)) / math.log(10) + extra
                kept = [part.column(part.schema.get_field_index(c)) for c in _KEPT]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(model, pa.float64())], [*_KEPT, "model"])

    return run


def score_texts(docs: DataFrame, held_out: Column, rounds=ROUNDS, head_words: int = HEAD_WORDS) -> DataFrame:
    """Train on the rows of ``docs`` that are not held out, and score all of them.

    ``docs`` needs ``doc_id`` and ``text``; a null text counts as empty, a null id is
    kept. Repeated rows and ids each give a row. Without any training row every word
    is unknown and all scores are those of the untrained model. Columns: doc_id,
    held_out, n_tokens, n_known, train_tokens, base_score, score (both log10).
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), held_out.alias("held_out"))
    training = rows.where(~F.col("held_out"))
    counts = staged(word_counts(training), "lm-counts")
    vocab, ends = vocabulary(counts, head_words), end_count(counts)
    sent = spark.sparkContext.broadcast(vars(vocab))
    numbered = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "held_out", "text")
    encoded = staged(numbered.mapInArrow(_encode_task(sent, ends), _ENCODED), "lm-codes")
    weights = train(encoded.where(~F.col("held_out")), F.col("doc_id"), start_weights(vocab), rounds)
    sent_weights = spark.sparkContext.broadcast(weights)
    scored = encoded.drop("rare").mapInArrow(_score_task(sent_weights), _SCORED)

    # rarer words: one row per text and word, looked up by a join
    outside = (F.col("n") < vocab.least) | (F.length("word") > HEAD_BYTES)
    rare = encoded.select("row", F.inline("rare").alias("word", "n"))
    found = rare.join(
        counts.where(outside & (F.length("word") > 0)).select("word", F.col("n").alias("c")), "word"
    )
    per_row = found.groupBy("row").agg(
        F.sum("n").alias("rare_known"), F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("rare_log")
    )
    rare_log = F.coalesce("rare_log", F.lit(0.0))
    whole = math.log10(vocab.total + vocab.types + 1)
    return scored.join(per_row, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(vocab.total).cast("long").alias("train_tokens"),
        (F.col("log_counts") + rare_log - F.col("n_tokens") * F.lit(whole)).alias("base_score"),
        (F.col("model") + rare_log).alias("score"),
    )
